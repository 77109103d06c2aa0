"""spindle.plans"""
