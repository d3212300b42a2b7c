"""tallyweave.sources"""
