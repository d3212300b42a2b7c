"""tallyweave.streaming"""
