"""lexflume.operators"""
