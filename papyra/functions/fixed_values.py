"""These must stay as they are for results to agree."""

from __future__ import annotations

# Columns of the prepared paper table.
PREPARED_COLUMNS = (
    "publish_time", "title", "abstract", "covid_related", "virus_related",
    "corona_related", "sars_related", "url",
)

# Date bound of the covid tag, and of the "recent papers" filter.
COVID_TAG_DATE = "2019-11-30"
RECENT_DATE = "2022-01-01"

# A title shorter than this must match RELEVANT_TITLE to be kept.
SHORT_TITLE = 30

# Patterns. rlike() searches anywhere in the text, so none starts with ".*",
# which would only make unmatched text slow. "nosocomial" and "epidem" count only together.
RELEVANT_TITLE = "vir|sars|mers|corona|ncov|immun|nosocomial.*epidem|emerg|vacc|cytokine"
ABSTRACT_NOISE = "(Publisher|Abstract|Summary|BACKGROUND|INTRODUCTION)"
UNKNOWN_ABSTRACT = "Unknown"
COVID_TERMS = ("covid", "sars-?n?cov-?2", "2019-ncov", "novel coronavirus", "sars coronavirus 2")
VIRUS_PATTERN = "virus|viruses|viral"
CORONA_PATTERN = "corona"
SARS_PATTERN = "sars"

# Columns whose nulls become empty text.
NULL_FILLED = ("authors", "doi", "journal", "abstract")

# Characters removed before tokenising, and the one that becomes a space.
REMOVED_CHARACTERS = "():,;.’”“?%><≥≤~`'"
SPACE_CHARACTER = "/"

# White space beyond ASCII (and the ASCII separators that regular expressions do
# not count), which parts words and sentences like a plain space.
UNICODE_SPACES = (
    "\x0b\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008"
    "\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# Between two tokens stands white space, a quote, a bracket, one of ! @ # $ & *
# or a double dash. Each separates for itself: the empty words between them are too short to be tokens.
TOKEN_SEPARATORS = "\t\n\f\r !@#$&[]{}\"*«»‘„"
TOKEN_DASHES = "--"

# A token starts with a year of 19xx or 20xx, or with a letter a-z followed by
# nothing but letters, digits, "_" and "-", of which those of ASCII are passed over first, as that
# is faster. It has at least two characters.
TOKEN_PATTERN = r"^(19|20)[0-9]{2}|^[a-z][a-z0-9_\-]*+[\p{L}\p{N}_\-]*$"
MIN_TOKEN_LENGTH = 2

# A sentence runs to a . ! or ? before white space, else to the end of its line.
SENTENCE_PATTERN = r"(?:\S[^\n]+?[.!?](?:\s+|$))|(?:\S[^\n]+?(?:\n|$))"
# Abbreviations ("Dr. No", "e.g. a") after which no sentence ends. These and the
# sentence pattern are those of a public summariser, whose results they must match.
TITLE_ABBREVIATION = r"([A-Z][a-z]{1,2}\.)\s([\p{L}\p{N}_])"
LETTER_ABBREVIATION = r"(\.[a-zA-Z]\.)\s([\p{L}\p{N}_])"

# BM25 parameters.
BM25_K1 = 1.5
BM25_B = 0.75
BM25_EPSILON = 0.25

# Sizes used when presenting hits.
NUM_RESULTS = 10
SHORTEN_LENGTH = 200
ABSTRACT_LENGTH = 300
SUMMARY_LENGTH = 500
SUMMARY_WORDS = 120
SUMMARY_RATIO = 0.2

# Words that are never tokens.
PAPER_STOP_WORDS = (
    "introduction", "abstract", "section", "edition", "chapter", "copyright", "preprint",
    "figure",
)
ENGLISH_STOP_WORDS = (
    "and", "the", "is", "any", "to", "by", "of", "on", "or", "with", "which", "was", "be", "we",
    "are", "so", "for", "it", "in", "they", "were", "as", "at", "such", "no", "that", "there",
    "then", "those", "not", "all", "this", "their", "our", "between", "have", "than", "has",
    "but", "why", "only", "into", "during", "some", "an", "more", "had", "when", "from", "its",
    "it's", "been", "can", "further", "above", "before", "these", "who", "under", "over", "each",
    "because", "them", "where", "both", "just", "do", "once", "through", "up", "down", "other",
    "here", "if", "out", "while", "same", "after", "did", "being", "about", "how", "few", "most",
    "off", "should", "until", "will", "now", "he", "her", "what", "does", "itself", "against",
    "below", "themselves", "having", "his", "am", "whom", "she", "nor", "hers", "too", "own",
    "ma", "him", "theirs", "again", "doing", "ourselves", "re", "me", "ours", "ie", "you", "your",
    "herself", "my", "et", "al", "may", "due", "de", "one", "two", "three", "four", "five", "six",
    "seven", "eight", "nine", "ten", "however", "i", "ii", "iii", "iv", "v", "vii", "viii", "ix",
    "x", "xi", "xii", "xiii", "xiv",
)
# "cannot" reads as "can not", which are two stop words.
SPLIT_STOP_WORDS = ("cannot",)
STOP_WORDS = ENGLISH_STOP_WORDS + PAPER_STOP_WORDS + SPLIT_STOP_WORDS
