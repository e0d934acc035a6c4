"""lexflume.plans"""
