"""Training-data operators: media, archives, chat text, tokens, filters, mixtures, shards,
language, near duplicates and vector search. Nothing outside this subpackage imports it."""
