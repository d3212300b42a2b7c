"""tallyweave.plans"""
