"""venueweave.sources"""
