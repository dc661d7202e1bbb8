"""reuselens.operators"""
