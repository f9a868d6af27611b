"""venueweave.plans"""
