"""reuselens.sources"""
