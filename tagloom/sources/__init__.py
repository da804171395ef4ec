"""Reading business data named by tag rules, and writing keyed results."""
