"""venueweave.streaming"""
