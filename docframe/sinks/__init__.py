"""docframe.sinks"""
