"""Fixed values of the analytics rules.

Everything in this module is a *fixed value*: word lists, patterns, weights,
thresholds, prices and message formats that the results depend on.  They are
stated as plain text so that a reader can check them one by one.  No logic
lives here.
"""

# --------------------------------------------------------------------------
# Domains
# --------------------------------------------------------------------------
INTENTS = ("complaint", "technical_issue", "billing_dispute", "inquiry",
           "account_management", "general", "feedback")
SENTIMENTS = ("very_negative", "negative", "neutral", "positive", "very_positive")
LEVELS = ("critical", "high", "medium", "low")
PRODUCTS = ("retirement_fund", "credit_card", "mortgage", "etf", "savings_account",
            "loan", "insurance", "investment")
COMPLAINT_INTENTS = ("complaint", "technical_issue", "billing_dispute")

# --------------------------------------------------------------------------
# Turn scoring
# --------------------------------------------------------------------------
HIGH_KEYWORDS = ("complaint", "refund", "cancel", "terrible", "awful", "fraud",
                 "dispute", "lawsuit", "error", "bug", "broken", "not working")
MEDIUM_KEYWORDS = ("question", "how to", "need help", "issue", "problem", "confused")

COMPLAINT_RX = (r"\b(complaint|complain|terrible|awful|horrible|frustrated|angry|"
                r"unacceptable|disappointed|refund|cancel|lawsuit|fraud)\b")
ISSUE_RX = (r"\b(issue|problem|error|bug|broken|not working|failed|wrong|"
            r"mistake|incorrect|dispute)\b")
QUESTION_RX = (r"\b(how|what|when|where|why|can you|could you|would you|"
               r"question|help|explain|understand)\b")
NEGATIVE_RX = (r"\b(hate|terrible|awful|bad|horrible|worst|disappointed|"
               r"frustrated|annoyed|upset|angry)\b")
POSITIVE_RX = (r"\b(great|excellent|perfect|thank|thanks|appreciate|wonderful|"
               r"fantastic|amazing|love|happy)\b")

BILLING_WORDS = ("charge", "bill", "fee", "payment")
BILLING_FAULT_WORDS = ("wrong", "incorrect", "dispute")
ACCOUNT_WORDS = ("update", "change", "modify", "account")

PRODUCT_MENTIONS = {
    "credit card": ("credit card", "card"),
    "mortgage": ("mortgage", "home loan"),
    "retirement fund": ("retirement", "401k", "pension", "ira"),
    "etf": ("etf", "index fund", "mutual fund"),
    "savings": ("savings account", "savings"),
    "loan": ("loan", "lending"),
}
ISSUE_MENTIONS = ("access", "login", "password", "fee", "charge", "error", "bug", "delay",
                  "late", "declined", "unauthorized", "fraud", "dispute")

BASE_SCORE = 0.3
INTENT_WEIGHT = {"complaint": 0.4, "technical_issue": 0.3, "billing_dispute": 0.35,
                 "inquiry": 0.15, "account_management": 0.1, "general": 0.0, "feedback": 0.05}
SENTIMENT_WEIGHT = {"very_negative": 0.2, "negative": 0.1, "neutral": 0.0,
                    "positive": -0.05, "very_positive": -0.1}
HIGH_KEYWORD_BONUS, HIGH_KEYWORD_CAP = 0.15, 0.3
MEDIUM_KEYWORD_BONUS, MEDIUM_KEYWORD_CAP = 0.05, 0.1
CUSTOMER_BONUS = 0.1

CRITICAL_AT, HIGH_AT, MEDIUM_AT = 0.7, 0.4, 0.2
CUSTOMER_SHARE, AGENT_SHARE = 0.7, 0.3
INTENT_SEVERITY = {"complaint": 3, "billing_dispute": 3, "technical_issue": 2, "inquiry": 1,
                   "account_management": 1, "general": 0, "feedback": 0}
SENTIMENT_SEVERITY = {"very_negative": 2, "negative": 1, "neutral": 0, "positive": -1,
                      "very_positive": -2}
MIN_CRITICAL_SEGMENTS = 2
REASON_CRITICAL = "Critical importance score"
REASON_COMPLAINT = "Complaint detected"
REASON_SEGMENTS = "%d high-priority segments"

# The documented alternative score: weights and feature maps.
ALT_WEIGHTS = {"intent": 0.4, "sentiment": 0.2, "keywords": 0.3, "speaker": 0.1}
ALT_INTENT = {"complaint": 1.0, "technical_issue": 0.85, "billing_dispute": 0.9,
              "inquiry": 0.4, "general": 0.0}
ALT_SENTIMENT = {"very_negative": 1.0, "negative": 0.5, "neutral": 0.0, "positive": -0.25,
                 "very_positive": -0.5}
ALT_HIGH, ALT_HIGH_CAP, ALT_MEDIUM, ALT_MEDIUM_CAP = 0.5, 1.0, 0.25, 0.5

# --------------------------------------------------------------------------
# Models and prices (US dollars per 1,000 tokens)
# --------------------------------------------------------------------------
CHEAP_MODEL, EXPENSIVE_MODEL = "gpt-3.5-turbo", "gpt-4-turbo-preview"
EXPENSIVE_MARK = "gpt-4"
CHEAP_IN, CHEAP_OUT = 0.0015, 0.002
EXPENSIVE_IN, EXPENSIVE_OUT = 0.01, 0.03
EMBEDDING_PRICE, EMBEDDING_TOKENS_PER_DOC = 0.00002, 100
EMBEDDING_MODEL = "sentence-transformers"
TIERED_MODELS = {"critical": "gpt-4", "high": "gpt-3.5-turbo", "medium": "gpt-3.5"}
SEARCH_COST, ANALYTICS_COST = 0.001, 0.0

# --------------------------------------------------------------------------
# Conversation noise
# --------------------------------------------------------------------------
GREETING_RX = (r"^(hi|hello|hey|good morning|good afternoon)",
               r"how are you",
               r"have a (great|good|nice) day",
               r"thank you for calling",
               r"my name is \w+")
PROCEDURAL_RX = (r"can you (verify|confirm|provide)",
                 r"let me (check|look|pull up)",
                 r"please hold",
                 r"one moment",
                 r"for security purposes")
FILLER_RX = r"\b(um|uh|er|ah|hmm|you know|I mean|like|basically|actually)\b"

GREETING_FULL_RX = (r"^(hi|hello|hey|good morning|good afternoon|good evening)",
                    r"\bhow are you( doing| today)?\b",
                    r"\bhave a (great|good|nice|wonderful) (day|morning|afternoon|evening)",
                    r"\bthanks? for (calling|your (time|patience|call))",
                    r"\bmy name is \w+\b")
PROCEDURAL_FULL_RX = (r"\bcan you (verify|confirm|provide|give me)\b",
                      r"\blet me (check|look|pull up|see|verify)",
                      r"\b(please|just) hold\b",
                      r"\bone (moment|second|minute)( please)?\b",
                      r"\b(bear|hang on) with me\b",
                      r"\byour (account|reference|confirmation) number\b",
                      r"\bfor (security|verification) purposes\b",
                      r"\blast (four|4) (digits|of)",
                      r"\bdate of birth\b")
FILLER_FULL_RX = (r"\b(um|uh|er|ah|hmm)\b",
                  r"\byou know\b",
                  r"\bI mean\b",
                  r"\blike\b(?! to)",
                  r"\bbasically\b",
                  r"\bactually\b(?! \w)",
                  r"\bkind of\b",
                  r"\bsort of\b",
                  r"\bI guess\b")
HOLD_RX = (r"\b(hold|holding|on hold)\b",
           r"\btransferring you to\b",
           r"\bplease wait\b",
           r"\bmusic playing\b",
           r"\b\[silence\]\b")
CLOSING_RX = (r"\bhave a (great|good|nice)",
              r"\bthanks? for (calling|your time)",
              r"\bis there anything else",
              r"\bglad (I could|to) help")

GREETING_SIMPLE_RX = (r"^(hi|hello|hey|good morning|good afternoon)",
                      r"how are you",
                      r"have a (great|good|nice) day",
                      r"thank you for calling",
                      r"my name is \w+",
                      r"is there anything else",
                      r"thanks for (your|the) (help|time)")
PROCEDURAL_SIMPLE_RX = (r"can you (verify|confirm|provide)",
                        r"let me (check|look|pull up|verify)",
                        r"please hold",
                        r"one moment",
                        r"give me (a|one) (second|moment)",
                        r"your (account|confirmation) number is",
                        r"for (security|verification) purposes")

RESOLUTION_RX = (r"\b(fixed|resolved|solution|try this|here's what)\b",
                 r"\b(I've (sent|updated|changed|fixed))\b",
                 r"\b(should work now|that should fix)\b")
TOPIC_MARKER_RX = r"\b(anything else|next question|also|additionally)\b"
SUMMARY_ISSUE_RX = r"\b(issue|problem|concern)\b"
SUMMARY_RESOLUTION_RX = r"\b(resolved|fixed|solution)\b"
SUMMARY_PARTY_RX = r"\b(customer|agent)\b"

NEGATIVE_WORDS = ("terrible", "awful", "horrible", "frustrated", "angry", "disappointed",
                  "issue", "problem", "error")
NEGATIVE_WORDS_MULTI = ("terrible", "awful", "horrible", "bad", "worst", "frustrated",
                        "angry", "disappointed", "upset")
IMPORTANT_WORDS = ("cancel", "refund", "complaint", "issue", "problem", "error", "fraud",
                   "dispute", "lawsuit", "broken")
USEFUL_WORDS = ("question", "help", "confused", "understand", "change", "update", "modify")

NO_CONTENT = "No significant content found."

# --------------------------------------------------------------------------
# Search, answers
# --------------------------------------------------------------------------
KEYWORD_WEIGHT, SEMANTIC_WEIGHT = 0.3, 0.7
TOP_K, RERANK_K, CONTEXT_TOKENS = 10, 5, 4000
MAX_FEATURES = 10000
RRF_K = 60
EMBEDDING_DIM = 64

SEARCH_NONE = "No relevant calls found for your query."
ANSWER_NONE = ("I couldn't find any relevant call transcripts matching your query. "
               "Try rephrasing or broadening your search.")

# --------------------------------------------------------------------------
# Question routing
# --------------------------------------------------------------------------
ANALYTICS_RX = (r"\bhow many\b", r"\bcount\b", r"\bnumber of\b", r"\btotal\b",
                r"\bpercentage\b", r"\bpercent\b", r"\bratio\b", r"\bproportion\b",
                r"\btrend\b", r"\bover time\b", r"\bhistory\b", r"\blast (week|month|year)\b",
                r"\btop\b", r"\bmost common\b", r"\bhighest\b", r"\blowest\b", r"\brank\b",
                r"\baverage\b", r"\bmean\b", r"\bmedian\b")
SEARCH_RX = (r"\bfind\b", r"\bshow me\b", r"\blist\b", r"\bget\b", r"\bwhich calls\b",
             r"\blook for\b")
INSIGHT_RX = (r"\bwhat are.*saying\b", r"\bsummarize\b", r"\bexplain\b", r"\bwhy\b",
              r"\binsight\b", r"\banalysis\b", r"\bpattern\b", r"\btheme\b",
              r"\bcommon.*issue\b", r"\bmain.*concern\b")
ROUTE_CONFIDENCE, ROUTE_FLAG = 0.6, 0.3

QUESTION_PRODUCTS = {
    "credit_card": ("credit card", "card"),
    "mortgage": ("mortgage", "home loan"),
    "retirement_fund": ("retirement", "401k", "pension"),
    "etf": ("etf", "fund"),
    "savings": ("savings",),
    "loan": ("loan",),
}
QUESTION_COMPLAINT_WORDS = ("complaint", "complain", "issue", "problem")
QUESTION_INQUIRY_WORDS = ("question", "inquiry", "ask")
TIMEFRAME_RX = r"\blast (day|week|month|year)\b"

# question kind -> words that mark it, tried in this order
QUESTION_KINDS = (("count", ("how many", "count", "number of")),
                  ("percentage", ("percentage", "percent", "ratio")),
                  ("trend", ("trend", "over time", "history")),
                  ("top", ("top", "most common", "highest")))
# word in the question -> stored product name (the last one found wins)
ASKED_PRODUCTS = (("credit card", "credit_card"), ("mortgage", "mortgage"),
                  ("retirement", "retirement_fund"), ("etf", "etf"),
                  ("savings", "savings_account"), ("loan", "loan"))
ASKED_INTENTS = (("complaint", ("complaint",)),
                 ("technical_issue", ("issue", "problem")),
                 ("inquiry", ("question", "inquiry")))
CACHE_TTL_SECONDS = 3600
SUMMARY_TTL_DAYS = 30

# --------------------------------------------------------------------------
# Personal data
# --------------------------------------------------------------------------
PII_RX = {
    "email": r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b",
    "phone": r"\b(\d{3}[-.]?)?\d{3}[-.]?\d{4}\b",
    "ssn": r"\b\d{3}-\d{2}-\d{4}\b",
    "credit_card": r"\b\d{4}[-\s]?\d{4}[-\s]?\d{4}[-\s]?\d{4}\b",
}
PII_TOKENS = {"email": "[EMAIL]", "phone": "[PHONE]", "ssn": "[SSN]",
              "credit_card": "[CREDIT_CARD]"}
REDACTION_ORDER = ("email", "ssn", "credit_card", "phone")

# --------------------------------------------------------------------------
# Monitoring
# --------------------------------------------------------------------------
ALERT_ERROR_RATE, ALERT_P99_SECONDS, ALERT_HOURLY_COST = 0.05, 10.0, 100.0
ALERT_CACHE_HITS, ALERT_ENRICHMENT_RATE = 0.30, 0.25
FEEDBACK_THUMBS, FEEDBACK_RATING = 0.8, 4.0
THRESHOLD_GRID = (0.3, 0.4, 0.5, 0.6, 0.7, 0.8)
TRAILING_DAYS = (1, 7, 30, 90)

# --------------------------------------------------------------------------
# English stop words: Spark's default list without the entries that hold an
# apostrophe (a token never does).
# --------------------------------------------------------------------------
STOP_WORDS = tuple("""
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she
her hers herself it its itself they them their theirs themselves what which who whom this that
these those am is are was were be been being have has had having do does did doing a an the and
but if or because as until while of at by for with about against between into through during
before after above below to from up down in out on off over under again further then once here
there when where why how all any both each few more most other some such no nor not only own
same so than too very s t can will just don should now cannot could ought would
""".split())
