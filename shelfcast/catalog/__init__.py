"""Every operator as a named query over the star-schema tables, with an equivalent SQL text."""
