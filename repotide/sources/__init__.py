"""Where data comes from and goes to: landing files, stored tables, databases."""
