"""spindle.operators"""
