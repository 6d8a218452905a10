"""docframe.plans"""
