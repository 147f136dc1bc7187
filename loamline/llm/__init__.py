"""Training-data operators: scoring, media, licences, mixing, sharding, rules, tokens, near-duplicates.

Nothing outside this subpackage imports it; it can be removed as a whole.
"""
