"""Word lists used by the default queries on the driver corpus.

The reference ships Korean lists (a 610-entry stop list, a 304-entry keyword
blacklist); lists of that size are taken as parameters (``read_stopwords``,
``drop_blacklisted``) rather than embedded. The corpus here is European
prose, so the default queries use these short lists of our own.
"""

# Function words of the four corpus languages (en, fr, de, es).
FUNCTION_WORDS = (
    "the", "and", "of", "to", "in", "is", "was", "that", "with", "for", "from", "as",
    "by", "on", "at", "it", "be", "are", "or", "an", "this", "than",
    "le", "la", "les", "de", "des", "et", "en", "du", "un", "une", "pour", "par",
    "sur", "dans", "que", "qui", "pas",
    "der", "die", "das", "und", "zu", "von", "mit", "den", "ist", "sich", "für",
    "auf", "ein", "eine", "nicht",
    "el", "los", "las", "y", "con", "por", "para", "una", "se", "no", "del",
)

# Generic words kept out of keyword lists (K12 blacklist role).
GENERIC_WORDS = ("with", "from", "that", "this", "than", "tion", "ing", "ed")
