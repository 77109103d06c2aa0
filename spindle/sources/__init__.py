"""spindle.sources"""
