"""lexflume.sources"""
