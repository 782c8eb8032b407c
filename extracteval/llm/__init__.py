"""Training-data operators: sharding, PII, token files, quality, chat, packing, search, toxicity,
decontamination and near-duplicate removal.  Nothing else in the library imports this package."""
