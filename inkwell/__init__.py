"""inkwell: document archives as DataFrames, from spans on a page to cited context."""
