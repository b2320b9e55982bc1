"""textlab.sources"""
