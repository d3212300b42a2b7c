"""tallyweave.operators"""
