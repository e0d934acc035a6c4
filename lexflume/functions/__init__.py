"""lexflume.functions"""
