"""textlab.streaming"""
