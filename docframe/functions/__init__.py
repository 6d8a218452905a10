"""docframe.functions"""
