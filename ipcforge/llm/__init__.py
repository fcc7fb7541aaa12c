"""Training-data operators (quality, search, packing, tokens, HTML, secrets, LM, dedup, PII).

Nothing else in the library imports this subpackage; it imports only general
helpers (session, shared tables) from the rest.
"""
