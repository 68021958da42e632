"""Training-data operators: quality, fingerprints, licences, decontamination, dedup, chat, tokens, language."""
