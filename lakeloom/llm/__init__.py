"""Training-data operators: mixing, deduplication, quality, toxicity, language,
decontamination, chat formatting, token counts and vector search.

Nothing outside this subpackage imports it. Every operator has a general
interface in its own module; ``queries.py`` holds the registered queries.
"""
