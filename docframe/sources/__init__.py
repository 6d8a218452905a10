"""docframe.sources"""
