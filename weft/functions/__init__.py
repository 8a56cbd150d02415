"""weft.functions"""
