"""Column functions: text, HTML tables, Markdown and CSS selectors."""
