"""streaming"""
