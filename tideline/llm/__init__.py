"""Operators for training-data corpora: quality, licences, search, chat, urls, packing, tokens, archives, copies."""
