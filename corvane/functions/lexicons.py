"""Small dictionaries used by the text operators. All are replaceable arguments."""

# Ids of the special vocabulary entries.
SPECIAL_TOKENS = {"<PAD>": 0, "<UNK>": 1, "<BOS>": 2, "<EOS>": 3}

# Special tokens of the byte-pair vocabulary.
BPE_SPECIALS = ["[PAD]", "[UNK]", "[CLS]", "[SEP]", "[MASK]"]

# The built-in knowledge base (text, type, description).
KNOWLEDGE_BASE = [
    ("paris", "GPE", "Ranskan pääkaupunki"),
    ("france", "GPE", "Maa Euroopassa"),
    ("eiffel tower", "LANDMARK", "Ikonic torni Pariisissa"),
]

# Entity types that may enter the knowledge base.
KB_TYPES = ["GPE", "PERSON", "ORG", "FAC"]

# Candidate document tags.
CANDIDATE_TAGS = [
    "positive", "negative", "technical", "informal", "formal", "question", "instruction",
]

# Intents in the order in which they are reported.
INTENTS = ["list", "definition", "explanation", "comparison", "factoid"]

# Supported upload extensions, with the dot.
SUPPORTED_EXTENSIONS = [
    ".pdf", ".txt", ".md", ".png", ".jpg", ".jpeg", ".docx", ".csv", ".zip",
]

# Function words of the four corpus languages.
STOP_WORDS = [
    "a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "he", "in", "is",
    "it", "of", "on", "or", "that", "the", "this", "to", "was", "with", "what", "where",
    "who", "when", "which", "how", "why",
    "das", "dem", "den", "der", "des", "die", "für", "im", "ist", "mit", "nicht",
    "sich", "und", "von", "zu",
    "au", "dans", "de", "du", "en", "est", "et", "la", "le", "les", "par", "pas",
    "pour", "que", "qui", "sur", "un", "une",
    "del", "el", "las", "los", "no", "por", "se", "y",
]

# Prepositions and question adverbs that mark an explanation question.
EXPLAIN_WORDS = [
    "about", "after", "at", "before", "between", "by", "for", "from", "in", "into",
    "of", "on", "over", "through", "to", "under", "with", "how", "why", "when", "where",
]

SENTIMENT = {
    "good": 0.7, "great": 0.8, "excellent": 1.0, "happy": 0.8, "useful": 0.3,
    "bad": -0.7, "poor": -0.4, "terrible": -1.0, "sad": -0.5, "wrong": -0.5,
}

SYNONYMS = [
    ("car", "automobile"), ("car", "motor_car"), ("big", "large"), ("big", "great"),
    ("fast", "quick"), ("city", "metropolis"), ("tower", "column"),
]

# (tag, token, weight) of the keyword tagger; the bias is an argument.
TAG_KEYWORDS = [
    ("positive", "good", 2.0), ("positive", "great", 2.0), ("negative", "bad", 2.0),
    ("negative", "wrong", 2.0), ("technical", "data", 2.0), ("technical", "system", 2.0),
    ("informal", "hey", 3.0), ("formal", "therefore", 2.0), ("question", "why", 2.0),
    ("question", "how", 2.0), ("instruction", "must", 2.0), ("instruction", "please", 2.0),
]

# Request ceilings (action, window in seconds, limit).
RATE_LIMITS = [
    ("login", 60, 10), ("upload", 60, 10), ("update", 60, 10), ("delete", 60, 10),
    ("restore", 60, 10), ("review", 60, 10), ("question", 60, 20), ("register", 60, 5),
    ("export", 60, 5), ("backup", 60, 5),
]
# Ceilings over all actions of one user (window in seconds, limit).
DEFAULT_LIMITS = [(86400, 200), (3600, 50)]
