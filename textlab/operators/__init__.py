"""textlab.operators"""
