"""The supplied tables seen as trips, and one query with its SQL check per operator."""
