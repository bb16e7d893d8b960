"""Operators for preparing training text: copies, language, quality, personal data, tokens, packing, pages."""
