"""Rules and schedules compiled to DataFrame plans."""
