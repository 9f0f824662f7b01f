"""Word lists and character classes that results depend on."""

# Matching is by substring on lower-cased text, each word counted once.
POSITIVE_WORDS = ("bullish", "buy", "up", "rise", "gain", "profit", "positive")
NEGATIVE_WORDS = ("bearish", "sell", "down", "fall", "loss", "negative", "crash")
MARKET_TERMS = ("nifty", "sensex", "stock", "market", "trade", "investment", "portfolio")
TECHNICAL_PHRASES = (
    "support", "resistance", "breakout", "breakdown", "moving average", "rsi", "macd",
    "bollinger", "volume", "trend", "pattern",
)
RATE_LIMIT_PHRASES = (
    "rate limit", "too many requests", "429", "quota", "limit exceeded", "throttled",
)

# Script name -> Unicode block.
INDIC_BLOCKS = {
    "hindi": r"\x{0900}-\x{097F}",
    "tamil": r"\x{0B80}-\x{0BFF}",
    "telugu": r"\x{0C00}-\x{0C7F}",
    "kannada": r"\x{0C80}-\x{0CFF}",
    "malayalam": r"\x{0D00}-\x{0D7F}",
}

# Whitespace as Unicode text splitting sees it (Java's \s is ASCII only).
SPACE = r"\t-\r\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
# Letters, numbers and underscore; combining marks are not word characters.
WORD = r"\p{L}\p{N}_"
# Pictographs, dingbats, flags, variation selector and joiner.
EMOJI = r"\x{1F300}-\x{1FAFF}\x{2600}-\x{27BF}\x{1F1E6}-\x{1F1FF}\x{FE0F}\x{200D}"

URL = rf"https?://[^{SPACE}]+|www\.[^{SPACE}]+"
MENTION = rf"@[{WORD}]+"
HASHTAG = rf"#[{WORD}]+"
EMOJI_CHAR = rf"[{EMOJI}]"
# What is outside printable ASCII and the five scripts, listed as ranges: Java evaluates
# this several times faster than the negated union, and single characters below U+0100 are looked up at once. Tamil to Malayalam are adjacent.
NOT_KEPT = "[" + "".join(rf"\x{c:02x}" for c in (*range(0x20), *range(0x7F, 0x100))) + r"\x{0100}-\x{08FF}\x{0980}-\x{0B7F}\x{0D80}-\x{10FFFF}]+"
NOT_ASCII = r"[^\x00-\x7F]+"
TOKEN = rf"[{WORD}]{{2,}}"

# Spark's own English stop words (StopWordsRemover), frozen so that saved
# vocabularies stay comparable across versions.
ENGLISH_STOP_WORDS = tuple(
    """
    i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her
    hers herself it its itself they them their theirs themselves what which who whom this that these
    those am is are was were be been being have has had having do does did doing a an the and but if or
    because as until while of at by for with about against between into through during before after
    above below to from up down in out on off over under again further then once here there when where
    why how all any both each few more most other some such no nor not only own same so than too very s
    t can will just don should now i'll you'll he'll she'll we'll they'll i'd you'd he'd she'd we'd
    they'd i'm you're he's she's it's we're they're i've we've you've they've isn't aren't wasn't
    weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't shouldn't mustn't can't
    couldn't cannot could here's how's let's ought that's there's what's when's where's who's why's
    would
    """.split()
)
