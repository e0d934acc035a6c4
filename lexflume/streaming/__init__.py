"""lexflume.streaming"""
