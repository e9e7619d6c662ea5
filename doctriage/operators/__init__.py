"""DataFrame operators: requests, extraction, answer parsing, scoring and classification, catalogue
look-ups and batch reports."""
