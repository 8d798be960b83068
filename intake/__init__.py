"""intake: checked, repeatable loading of delimited files into tables."""
