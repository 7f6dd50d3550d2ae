"""Column functions: text clean-up, typed decoding, keyed pseudonyms, labels."""
