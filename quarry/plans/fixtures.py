"""Fixed small inputs shared by the Spark queries and their SQL oracles.

FIXED VALUES: these lists are parameters of the registered queries and must
be identical on both sides; they are small user-style inputs (a lexicon, a
stopword list, a category dictionary, six cities), not data.
"""

# Valence lexicon (term, score); the last entry re-scores "ha": last wins.
# "can't stand" is a phrase and never matches a single token.
VALENCE = [
    ("good", 3), ("bad", -3), ("no", -1), ("yes", 1), ("ha", 2), ("haha", 3),
    ("die", -3), ("love", 3), ("hate", -3), ("best", 3), ("worst", -3),
    ("idiot", -3), ("worthless", -2), ("anti", -1), ("nicht", -1), ("pas", -1),
    ("license", 1), ("can't stand", -3), ("ha", 1),
]

# Category lexicon for polarity / subjectivity: +1 positive, -1 negative.
CATEGORIES = [
    ("good", 1), ("best", 1), ("haha", 1), ("ha", 1), ("yes", 1), ("love", 1),
    ("bad", -1), ("no", -1), ("idiot", -1), ("worthless", -1), ("anti", -1),
    ("die", -1), ("nicht", -1), ("pas", -1),
]

# Stopwords (one word per entry, as a stopword file would hold them).
STOPWORDS = [
    "a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "has",
    "he", "in", "is", "it", "its", "of", "on", "that", "the", "to", "was",
    "were", "will", "with", "this", "or", "not", "but", "we", "they",
    "le", "la", "les", "de", "des", "et", "un", "une", "que", "qui",
    "der", "die", "das", "und", "ein", "eine", "el", "los", "las", "y",
]

# Category dictionary in the ';' file's first column form: word#sense.
CATEGORY_DICTIONARY = [
    "ABLE#1", "BEST", "GOOD#1", "GOOD#2", "HA", "HAHA#3", "LICENSE",
    "THAT", "THIS#1", "WITH", "FROM#2", "WAS", "ARE#12",
]

# Cities: (name, latitude, longitude, area in square miles).
CITIES = [
    ("London", 51.5074, -0.1278, 607.0),
    ("Manchester", 53.4808, -2.2426, 44.6),
    ("Birmingham", 52.4862, -1.8904, 103.4),
    ("Leeds", 53.8008, -1.5491, 213.0),
    ("Glasgow", 55.8642, -4.2518, 68.0),
    ("Bristol", 51.4545, -2.5879, 42.0),
]

# Marker phrases of listing pages.
REMOVED_MARKERS = ["we are sorry but", "this property has been removed", "no longer available"]
LET_AGREED_MARKER = "let agreed"
