"""Fixed values.

Everything in this module is data that must keep these exact values for results to
match the behaviour being reproduced (category taxonomy, language names and order,
extra stopwords, thresholds).  Lexicons that drive the built-in default scorers are
our own and are marked as such.  Nothing here is computed; every table is small and
bounded, so it is safe to ship to executors as a literal or a broadcast relation.
"""

from __future__ import annotations

# --------------------------------------------------------------------------------------
# FIXED VALUES: issue / strength taxonomy (15 categories per sentiment).
# Columns: number, category, root cause, owner, priority, four recommended actions.
# --------------------------------------------------------------------------------------
NEGATIVE_TAXONOMY = [
    (1, "Content Effectiveness", "Content Design / Instructional Quality",
     "Academic + Instructional Design Team", "High",
     ["Introduce instructional design checklist", "Simplify complex concepts using structured flow",
      "Remove redundant content", "Ensure periodic content review for accuracy"]),
    (2, "Depth & Coverage", "Curriculum Design Gap", "Academic + SME Team", "High",
     ["Map curriculum to competency framework", "Add missing topics/modules",
      "Balance beginner vs advanced content", "Conduct SME validation"]),
    (3, "Practical Value", "Industry Alignment Gap", "Content Strategy + SME Team", "High",
     ["Add real-world use cases", "Align content with job roles", "Include hands-on exercises",
      "Incorporate industry scenarios"]),
    (4, "Content Structure", "Instructional Structuring Issue", "Instructional Design Team", "High",
     ["Define module-wise learning objectives", "Ensure logical sequencing", "Add summaries and recaps",
      "Introduce course roadmap at start"]),
    (5, "Instructor Effectiveness", "Faculty Capability / Delivery Gap", "Faculty Enablement Team", "High",
     ["Conduct train-the-trainer sessions", "Provide delivery guidelines",
      "Monitor instructor feedback scores", "Enable peer review of sessions"]),
    (6, "Engagement", "Content Delivery Design", "Content + Faculty Team", "Medium",
     ["Add storytelling elements", "Introduce interactive components (polls/quizzes)",
      "Use animations and visuals", "Break monotony in delivery"]),
    (7, "Examples & Case Studies", "Content Depth / Practicalization Gap", "Content + SME Team", "High",
     ["Add real-world case studies", "Include industry-specific examples", "Increase variety of examples",
      "Add practical demonstrations"]),
    (8, "Video & Audio Quality", "Production Quality", "Content Production Team", "High",
     ["Standardize audio/video recording guidelines", "Mandatory production QA before publishing",
      "Improve lighting and sound setup", "Ensure subtitle availability and accuracy"]),
    (9, "Pace & Content Length", "Content Optimization / Delivery Issue", "Content Strategy + Faculty", "Medium",
     ["Enforce ideal module duration (8-12 mins)", "Remove repetitive explanations",
      "Enable playback speed controls", "Split long modules into micro-learning units"]),
    (10, "Platform Experience (UI/UX & Navigation)", "UX Design / Information Architecture",
     "Product + UX Team", "High",
     ["Improve navigation and menu structure", "Redesign quiz interface for usability",
      "Add progress tracking & breadcrumbs", "Conduct usability testing"]),
    (11, "Performance & Technical Issues", "Platform Stability / Backend Performance", "Engineering Team",
     "Critical",
     ["Optimize backend performance", "Improve CDN and caching", "Fix login/session issues",
      "Conduct load and stress testing"]),
    (12, "Assessment Quality", "Evaluation Framework Design", "Assessment Design Team", "High",
     ["Align questions with learning objectives", "Improve clarity and relevance of questions",
      "Add diverse question formats", "Conduct SME validation"]),
    (13, "Difficulty Level", "Assessment Calibration Issue", "Assessment Team", "Medium",
     ["Balance easy/medium/hard questions", "Align difficulty with learner level",
      "Introduce adaptive difficulty", "Analyze learner performance data"]),
    (14, "Motivation & Engagement Continuity", "Retention Strategy Gap", "Product + Growth Team", "Medium",
     ["Introduce gamification (badges, streaks)", "Add progress tracking indicators",
      "Send nudges/reminders", "Provide milestone rewards"]),
    (15, "Support, Policy & Exceptions", "Support / Governance / Policy Issues", "Support + Operations Team",
     "Medium",
     ["Strengthen support response SLAs", "Clarify refund/certification policies",
      "Create escalation workflows", "Track and analyze recurring complaints"]),
]

POSITIVE_TAXONOMY = [
    (1, "Content Effectiveness", "Strong Instructional Design & Content Quality",
     "Academic + Instructional Design Team", "High",
     ["Replicate high-rated content patterns", "Create standardized content templates",
      "Document best practices", "Use as benchmark courses"]),
    (2, "Depth & Coverage", "Well-Designed Curriculum", "Academic + SME Team", "High",
     ["Use as curriculum reference model", "Expand advanced modules", "Maintain depth consistency",
      "Capture SME frameworks"]),
    (3, "Practical Value", "Strong Industry Alignment", "Content Strategy + SME Team", "High",
     ["Scale real-world use cases", "Highlight job-relevant modules", "Partner with industry experts",
      "Promote as career-focused courses"]),
    (4, "Content Structure", "Effective Instructional Structuring", "Instructional Design Team", "Medium",
     ["Standardize course structure templates", "Replicate sequencing models", "Build reusable blueprints",
      "Ensure consistent structure"]),
    (5, "Instructor Effectiveness", "High Faculty Capability", "Faculty Enablement Team", "High",
     ["Identify top instructors", "Use sessions for training", "Conduct knowledge-sharing",
      "Reward high performers"]),
    (6, "Engagement", "Effective Content Delivery Design", "Content + Faculty Team", "Medium",
     ["Replicate storytelling formats", "Increase interactivity", "Standardize engagement techniques",
      "Track engagement benchmarks"]),
    (7, "Examples & Case Studies", "Strong Practical Content Integration", "Content + SME Team", "High",
     ["Build case study repository", "Reuse high-quality examples", "Encourage industry scenarios",
      "Standardize case-based teaching"]),
    (8, "Video & Audio Quality", "High Production Standards", "Content Production Team", "Medium",
     ["Maintain production standards", "Document best practices", "Benchmark high-quality content",
      "Ensure consistency"]),
    (9, "Pace & Content Length", "Optimized Content Delivery", "Content Strategy + Faculty", "Medium",
     ["Maintain ideal module duration", "Promote micro-learning", "Replicate optimal pacing",
      "Use analytics for tuning"]),
    (10, "Platform Experience (UI/UX & Navigation)", "Strong UX Design", "Product + UX Team", "Medium",
     ["Retain successful UX patterns", "Standardize UI components", "Conduct usability benchmarking",
      "Scale intuitive designs"]),
    (11, "Performance & Technical Issues", "Stable Platform Performance", "Engineering Team", "High",
     ["Maintain performance benchmarks", "Monitor uptime & latency", "Scale infra proactively",
      "Continue load testing"]),
    (12, "Assessment Quality", "Strong Evaluation Framework", "Assessment Design Team", "High",
     ["Replicate best assessments", "Maintain alignment standards", "Expand quality question bank",
      "Use as templates"]),
    (13, "Difficulty Level", "Well-Calibrated Assessments", "Assessment Team", "Medium",
     ["Maintain difficulty balance", "Validate via analytics", "Replicate difficulty patterns",
      "Introduce adaptive models"]),
    (14, "Motivation & Engagement Continuity", "Effective Retention Strategy", "Product + Growth Team", "Medium",
     ["Scale gamification", "Enhance progress tracking", "Replicate high-completion journeys",
      "Strengthen engagement loops"]),
    (15, "Support, Policy & Exceptions", "Strong Support & Governance", "Support + Operations Team", "Low",
     ["Maintain SLA standards", "Document best practices", "Ensure transparency", "Monitor satisfaction"]),
]

# Category used when nothing else fits (the "use category 15 only as a last resort" rule).
FALLBACK_CATEGORY_NO = 15

# --------------------------------------------------------------------------------------
# FIXED VALUES: language code -> display name, per profile, and the display order.
# Codes missing from a map are shown title-cased (Python str.title semantics).
# --------------------------------------------------------------------------------------
LANG_NAMES_STRICT = {
    "hi": "Hindi", "en": "English", "ta": "Tamil", "te": "Telugu",
    "mr": "Marathi", "bn": "Bengali", "gu": "Gujarati", "kn": "Kannada",
    "ml": "Malayalam", "or": "Odia", "pa": "Punjabi", "as": "Assamese",
    "ur": "Urdu", "hinglish": "Hinglish", "unknown": "Hinglish",
}

LANG_NAMES_LENIENT = {
    "en-in": "English", "hi-in": "Hindi", "ta-in": "Tamil", "te-in": "Telugu",
    "mr-in": "Marathi", "bn-in": "Bengali", "gu-in": "Gujarati", "kn-in": "Kannada",
    "ml-in": "Malayalam", "or-in": "Odia", "pa-in": "Punjabi", "as-in": "Assamese",
    "ur-in": "Urdu",
    "hi": "Hindi", "en": "English", "ta": "Tamil", "te": "Telugu",
    "mr": "Marathi", "bn": "Bengali", "gu": "Gujarati", "kn": "Kannada",
    "ml": "Malayalam", "or": "Odia", "pa": "Punjabi", "as": "Assamese",
    "ur": "Urdu", "unknown": "Unknown",
}

LANG_ORDER = {
    "English": 1, "Hindi": 2, "Telugu": 3, "Marathi": 4, "Tamil": 5,
    "Urdu": 6, "Odia": 7, "Hinglish": 8, "Error": 9,
}
LANG_ORDER_LENIENT = {
    "English": 1, "Hindi": 2, "Telugu": 3, "Marathi": 4, "Tamil": 5,
    "Urdu": 6, "Odia": 7, "Unknown": 8, "Error": 9,
}
LANG_ORDER_DEFAULT = 99

# --------------------------------------------------------------------------------------
# FIXED VALUES: word-frequency extra stopwords.
# --------------------------------------------------------------------------------------
STOPWORDS_EXTRA = ["course", "hai", "please", "also", "really", "much", "ni", "ka", "ke", "ki", "se", "na"]

# --------------------------------------------------------------------------------------
# FIXED VALUES: dashboard and summary thresholds.
# --------------------------------------------------------------------------------------
SHORT_MAX_WORDS = 3                 # <= 3 words is "short", more is "full"
ALERT_HIGH_SHARE = 0.30             # negative share above -> High
ALERT_MEDIUM_SHARE = 0.15           # negative share above -> Medium
SKEW_DOMINANT_PCT = 40.0
SKEW_HIGH_PCT = 20.0
SKEW_MODERATE_PCT = 5.0
BAR_SCALE = 120
TOP_ISSUES = 15                     # strict profile; lenient profile shows 11
TOP_ISSUES_LENIENT = 11
TOP_STRENGTHS = 15
COURSE_TOP_CATEGORIES = 5
COURSE_TOP_LANGUAGES = 3
SAMPLE_COMMENTS = 5
SAMPLE_ACTIONS = 3
TIER_MAJOR_SHARE = 0.10
TIER_MIN_COUNT = 5
URGENCY_MEDIUM_SHARE = 0.05
TOP_PRIORITY_ACTIONS = 3
AMPLIFY_TOP = 3
TOP_STRENGTH_AREAS = 3
WORDS_TOP_K = 150
WORDS_MIN_LENGTH = 2
PRIORITY_RANK = {"Critical": 1, "High": 2, "Medium": 3, "Low": 4}

# --------------------------------------------------------------------------------------
# Defaults of our own (not taken from anywhere): the built-in deterministic scorers.
# Swap them for a model through the per-partition hook in operators/enrich.py.
# --------------------------------------------------------------------------------------

# Polarity lexicon, word -> weight.  Multilingual, lower case.
SENTIMENT_LEXICON = {
    # positive
    "good": 1, "great": 2, "excellent": 2, "best": 2, "helpful": 1, "useful": 1, "clear": 1,
    "love": 2, "loved": 2, "amazing": 2, "awesome": 2, "nice": 1, "wonderful": 2, "perfect": 2,
    "informative": 1, "engaging": 1, "interesting": 1, "thanks": 1, "thank": 1, "enjoyed": 2,
    "gut": 1, "toll": 2, "super": 1, "prima": 1, "bien": 1, "bon": 1, "génial": 2, "parfait": 2,
    "bueno": 1, "excelente": 2, "genial": 2, "útil": 1,
    # negative
    "bad": -1, "poor": -1, "worst": -2, "boring": -1, "useless": -2, "worthless": -2, "stupid": -2,
    "idiot": -2, "trash": -2, "terrible": -2, "awful": -2, "horrible": -2, "waste": -2, "confusing": -1,
    "difficult": -1, "problem": -1, "broken": -1, "hate": -2, "disappointing": -2, "annoying": -1,
    "schlecht": -1, "langweilig": -1, "mauvais": -1, "nul": -2, "ennuyeux": -1, "malo": -1, "aburrido": -1,
}

# Function-word profiles for the default language detector.  A word that appears in k
# profiles weighs LANGUAGE_WEIGHT_UNIT / k, so shared words ("de", "la", "en") count less.
LANGUAGE_PROFILES = [
    ("en", ["the", "of", "and", "to", "a", "in", "is", "that", "it", "for", "was", "on", "with", "as",
            "be", "by", "this", "are", "at", "an", "from"]),
    ("de", ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "für",
            "ist", "im", "dem", "nicht", "ein", "eine", "als", "auch"]),
    ("fr", ["de", "la", "le", "et", "les", "des", "en", "un", "une", "du", "que", "est", "pour", "qui",
            "dans", "par", "pas", "au", "sur", "avec", "ce"]),
    ("es", ["de", "la", "que", "el", "en", "y", "los", "del", "se", "las", "por", "un", "para", "con",
            "no", "una", "su", "al", "lo", "como", "es"]),
    ("hi", ["है", "के", "में", "की", "और", "का", "को", "से", "एक", "यह", "पर", "हैं", "भी", "नहीं"]),
]
LANGUAGE_WEIGHT_UNIT = 60           # divisible by 1..5, so all weights stay integers

# Keyword rules for the default categoriser: category number -> words.
CATEGORY_KEYWORDS = [
    (1, ["content", "material", "explained", "explanation", "concepts", "clarity"]),
    (2, ["depth", "coverage", "detailed", "topics", "shallow", "basic"]),
    (3, ["practical", "job", "industry", "applicable", "relevant", "skills"]),
    (4, ["structure", "organized", "sequence", "flow", "order", "modules"]),
    (5, ["instructor", "teacher", "faculty", "trainer", "sir", "madam", "speaker"]),
    (6, ["boring", "engaging", "interactive", "monotonous", "dull", "fun"]),
    (7, ["example", "examples", "case", "cases", "demonstration", "scenario"]),
    (8, ["video", "audio", "sound", "voice", "subtitle", "subtitles", "volume"]),
    (9, ["long", "lengthy", "pace", "speed", "fast", "duration"]),
    (10, ["navigation", "interface", "menu", "app", "website", "layout"]),
    (11, ["slow", "crash", "login", "error", "bug", "loading", "server"]),
    (12, ["quiz", "question", "questions", "assessment", "exam", "test"]),
    (13, ["difficult", "hard", "easy", "tough", "level", "complex"]),
    (14, ["motivation", "badge", "badges", "reminder", "streak", "rewards"]),
    (15, ["certificate", "support", "refund", "policy", "help", "issue"]),
]

# Summary rules stated only in prose upstream; these are our written-down parameters.
BLOCKING_PATTERN = "certificate|complet|login|access"
LOW_SIGNAL_PHRASES = ["bad", "good", "nice", "ok", "okay", "not good", "very good", "thanks", "thank you", "fine"]
LOW_SIGNAL_SHARE = 0.5

# English stopwords for the word-frequency report (our own list; the extras above are
# added to it).
STOPWORDS_DEFAULT = [
    "a", "about", "above", "after", "again", "against", "all", "am", "an", "and", "any", "are", "as", "at",
    "be", "because", "been", "before", "being", "below", "between", "both", "but", "by", "can", "could",
    "did", "do", "does", "doing", "down", "during", "each", "few", "for", "from", "further", "had", "has",
    "have", "having", "he", "her", "here", "hers", "herself", "him", "himself", "his", "how", "i", "if",
    "in", "into", "is", "it", "its", "itself", "just", "me", "more", "most", "my", "myself", "no", "nor",
    "not", "of", "off", "on", "once", "only", "or", "other", "ought", "our", "ours", "ourselves", "out",
    "over", "own", "same", "she", "should", "so", "some", "such", "than", "that", "the", "their", "theirs",
    "them", "themselves", "then", "there", "these", "they", "this", "those", "through", "to", "too", "under",
    "until", "up", "very", "was", "we", "were", "what", "when", "where", "which", "while", "who", "whom",
    "why", "with", "would", "you", "your", "yours", "yourself", "yourselves",
]

# --------------------------------------------------------------------------------------
# FIXED VALUES: field names of the per-comment analysis records on disk (needed to read
# and write files in the existing layout).
# --------------------------------------------------------------------------------------
ANALYSIS_RECORD_FIELD = "Gemini Analysis"
ANALYSIS_SENTIMENT_FIELD = "predicted sentiment"
ANALYSIS_FIELDS = {"issue": "Issue Category", "strength": "Strength Category", "root_cause": "Root Cause", "actions": "Recommended Actions",
                   "owner": "Owner", "priority": "Priority"}
