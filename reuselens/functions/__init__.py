"""reuselens.functions"""
