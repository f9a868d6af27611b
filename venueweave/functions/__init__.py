"""venueweave.functions"""
