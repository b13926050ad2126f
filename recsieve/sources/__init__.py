"""recsieve.sources"""
