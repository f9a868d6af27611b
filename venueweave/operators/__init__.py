"""venueweave.operators"""
