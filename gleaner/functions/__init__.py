"""Column functions: text, markup, urls, codes, entities."""
