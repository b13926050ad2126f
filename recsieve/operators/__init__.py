"""recsieve.operators"""
