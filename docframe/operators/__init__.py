"""docframe.operators"""
