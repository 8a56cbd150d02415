"""weft.operators"""
