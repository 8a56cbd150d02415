"""weft.streaming"""
