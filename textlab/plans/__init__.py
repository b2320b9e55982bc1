"""textlab.plans"""
