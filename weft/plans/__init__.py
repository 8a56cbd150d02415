"""weft.plans"""
