"""recsieve.functions"""
