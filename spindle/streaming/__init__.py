"""spindle.streaming"""
