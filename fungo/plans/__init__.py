"""The layered tables and the reports, profiles, checks and explores over them."""
