"""weft.sources"""
