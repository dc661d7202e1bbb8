"""reuselens.plans"""
