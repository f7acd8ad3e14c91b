"""The models, one function each, plus the ordered build."""
