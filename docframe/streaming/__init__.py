"""docframe.streaming"""
