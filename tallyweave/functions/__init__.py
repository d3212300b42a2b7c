"""tallyweave.functions"""
