"""Word lists, sources and thresholds that results depend on."""

# Sources: name, least lexicon hits, whether the markup gate applies, least characters, tiers, low trust, reference.
SOURCES = [
    ("wikipedia", 2, False, 2500, "foundational,practical,reference", False, True),
    ("wikisource", 2, False, 2500, "foundational,practical", False, True),
    ("wikibooks", 2, False, 2500, "foundational,practical", False, True),
    ("gutenberg", 3, False, 2500, "foundational,theoretical", False, True),
    ("openlibrary", 2, True, 2500, "foundational,practical,theoretical", False, True),
    ("archive_org", 2, True, 2500, "theoretical,practical,reference", False, True),
    ("stackexchange", 2, False, 800, "practical", False, True),
    ("youtube", 2, False, 1000, "foundational,practical", False, False),
    ("duckduckgo", 2, True, 1500, "foundational,practical", True, False),
    ("hathitrust", 2, False, 3000, "theoretical,practical,reference", False, True),
    ("dtic", 2, False, 2000, "theoretical,specialized", False, True),
    ("libretexts", 2, False, 1500, "foundational,theoretical,reference", False, True),
    ("core", 2, False, 2000, "theoretical,specialized,reference", False, True),
    ("skillscommons", 2, False, 1500, "foundational,practical", False, True),
    ("everyspec", 1, False, 2000, "specialized,reference", False, True),
    ("osha", 1, True, 1500, "safety,specialized,reference", False, True),
    ("reddit", 1, False, 800, "practical", True, False),
    ("cited", 1, True, 1200, "", True, False),
    ("hub", 1, True, 800, "foundational,practical", True, False),
]
LEXICON = ["that", "with", "this", "from", "tion", "ment", "elle", "rewh", "orre", "thatin", "sich", "pour"]
HTML_TAGS = ["<!doctype", "<html", "<head", "<body", "<script", "<style", "<meta", "<div", "<span"]
SUFFIXES = ["working", "smithing", "making", "crafting", "ing"]
OFF_TOPIC = ["administrative", "gameplay", "game modes", "demographics", "politics", "elections", "religion", "mythology", "fiction", "celebrity", "sports", "music album"]
SHORT_LIMIT = 2500
HAMMING = 4
DRIFT_WINDOW = 20
LICENCES = ["cc0", "public domain", "cc by", "cc-by", "pd"]
STOP_WORDS = ["with", "from", "this", "that", "these", "those", "were", "been", "being", "have", "does", "your", "will", "would", "should", "using", "used", "make", "made", "ensure", "ensures", "apply", "applies", "prevent", "prevents", "also", "then", "when", "while"]
# Words that mean nothing by themselves in a phrase.
IDLE_WORDS = ["the", "and", "for", "with", "from", "this", "that", "into", "their", "your", "you", "are", "was", "were", "have", "has", "use", "using", "used", "make", "made", "such", "more", "most", "also", "then", "when", "where", "while", "many", "some", "other"]
TITLE_BLOCKED = ["bible", "holy bible", "testament", "old testament", "new testament", "gospel", "gospels", "scripture", "scriptures", "quran", "koran", "torah", "talmud", "psalms", "proverbs", "ecclesiastes", "leviticus", "deuteronomy", "genesis", "exodus", "revelations", "a romance", "a novel", "a tale", "a story", "poems", "poetry", "sonnets", "ballads", "fairy tales"]
SKIP_DOMAINS = ["youtube.com", "youtu.be", "facebook.com", "twitter.com", "x.com", "instagram.com", "tiktok.com", "pinterest.com", "amazon.com", "amazon.co.uk", "ebay.com", "etsy.com", "google.com", "bing.com", "duckduckgo.com", "wikipedia.org", "archive.org", "gutenberg.org", "reddit.com", "github.com", "doi.org", "stackexchange.com", "stackoverflow.com"]
PEDAGOGY_HEADINGS = ["summary", "key takeaways", "review questions", "answer key", "learning outcomes", "try this"]
# Units with the least and largest plausible value.
RANGES = [("mW", 0.1, 500.0), ("W", 0.001, 50000.0), ("V", 0.5, 100000.0), ("A", 0.001, 5000.0), ("°C", -273.0, 5000.0), ("°F", -459.0, 9000.0), ("mm", 0.001, 100000.0), ("in", 0.001, 10000.0), ("psi", 0.01, 100000.0), ("sec", 0.001, 86400.0), ("min", 0.001, 1440.0), ("hr", 0.001, 720.0)]
# Spellings of the units of RANGES, and whether the unit may follow its number without a blank.
SPELLED_UNITS = [
    ("mW", ["mw"], False), ("W", ["w", "watt", "watts"], False), ("V", ["v", "volt", "volts"], False), ("A", ["a", "amp", "amps"], False), ("°C", ["°c"], True), ("°F", ["°f"], True), ("mm", ["mm"], False),
    ("in", ["in", "inch", "inches"], False), ("psi", ["psi"], False), ("sec", ["sec", "second", "seconds"], False), ("min", ["min", "minute", "minutes"], False), ("hr", ["hr", "hour", "hours"], False),
]
# Conversions: from, to, factor, shift, single numbers only. An ounce of leather is 0.4 mm thick.
CONVERSIONS = [("°C", "°F", 1.8, 32.0, False), ("°F", "°C", 5 / 9, -160 / 9, False), ("mm", "in", 1 / 25.4, 0.0, False), ("in", "mm", 25.4, 0.0, False), ("kg", "lb", 2.20462, 0.0, True), ("oz", "mm", 0.4, 0.0, False), ("mm", "oz", 2.5, 0.0, False)]
MACHINES = ["laser", "cutter", "engraver", "welder", "cnc"]
# Chapters of an outline made without a model: title (one that ends with a blank takes the book's name), topics (None: the
# book's tools), and keywords of the lexicon's entries that join them.
OUTLINE = [
    ("Introduction to ", ["history", "overview", "fundamentals", "scope"], ["history", "origin", "fundamental"]),
    ("Safety and Workspace Setup", ["safety", "ppe", "workspace", "hazards"], ["safe", "hazard", "ppe", "protection", "ventilation"]),
    ("Tools and Equipment", None, ["tool", "equipment", "machine", "instrument"]),
    ("Materials and Selection", ["materials", "properties", "grades"], ["material", "grade", "alloy", "wood", "metal", "fiber"]),
    ("Foundational Techniques", ["technique", "fundamentals"], ["technique", "method", "basic", "fundamental"]),
    ("Joinery and Connections", ["joint", "fastening", "assembly"], ["joint", "weld", "fasten", "bond", "connect"]),
    ("Intermediate Methods", ["accuracy", "precision"], ["intermediate", "precision", "control"]),
    ("Surface Treatment and Finishing", ["finish", "surface"], ["finish", "coat", "polish", "sand", "treat"]),
    ("Project Planning and Layout", ["planning", "layout", "measurement"], ["plan", "layout", "measure", "mark", "design"]),
    ("Quality and Inspection", ["inspection", "tolerances", "defects"], ["inspect", "defect", "tolerance", "quality", "test"]),
    ("Advanced Techniques", ["advanced", "specialized"], ["advanced", "specialist", "complex", "expert"]),
]
# Tools that are foreign to a craft, as patterns.
FOREIGN_TOOLS = {
    "leatherworking": [
        "bench plane", "jack plane", "hand plane", "lathe", "router table", "planer", "anvil", "forge", "crucible", "drill press", "bench grinder", "die grinder", "welder", "torch",
        "soldering iron", "chainsaw", "miter saw", "table saw",
    ],
    "blacksmithing": ["leather punch", "skiving knife", "bench plane", "router table", "sewing machine", r"awl(?!\s*shape)"],
    "carpentry": ["anvil", "forge", "tanning vat", "skiving knife", "swivel knife"],
    "woodworking": ["anvil", "forge", "skiving knife"],
    "welding": ["bench plane", "skiving knife", "tanning vat"],
    "blacksmith": ["leather punch", "bench plane", "sewing machine"],
}
