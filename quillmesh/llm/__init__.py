"""Training-data operators: quality, extraction, privacy, archives, packing, chat, toxicity, near duplicates, token
counts and decontamination. Nothing outside this subpackage imports it."""
