"""recsieve.plans"""
