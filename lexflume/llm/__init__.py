"""Operators for preparing training corpora; nothing else in lexflume imports this package."""
