"""Training-data operators: mixing, dedup, packing, language ID, extraction,
sharding, licence scans and quality scoring.

Nothing outside this subpackage imports it; it can be deleted as a whole.
"""
