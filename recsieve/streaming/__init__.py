"""recsieve.streaming"""
