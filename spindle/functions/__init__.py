"""spindle.functions"""
