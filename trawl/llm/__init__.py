"""Training-data operators: language ID, mixing, PII, chat formatting, token
files, quality, HTML extraction, nearest neighbours, near-dedup and
decontamination.  Nothing else in the library imports this subpackage."""
