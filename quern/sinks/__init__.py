"""Tables and files that operators write."""
