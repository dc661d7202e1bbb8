"""reuselens.streaming"""
