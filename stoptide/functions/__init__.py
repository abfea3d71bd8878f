"""Part of stoptide."""
