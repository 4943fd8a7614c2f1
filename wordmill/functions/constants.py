"""Fixed values. These must stay as they are for results to agree with the corpus format."""

# Placeholder written for each entity kind, in order of precedence.
PLACEHOLDERS = {
    "dates": "<DATE>",
    "emails": "<EMAIL>",
    "urls": "<URL>",
    "numbers": "<NUMBER>",
}

# Month stems a date may begin or end with.
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]

# The 127 English stopwords removed from token lists.
STOPWORDS = (
    "i me my myself we our ours ourselves you your yours yourself yourselves he him his himself "
    "she her hers herself it its itself they them their theirs themselves what which who whom "
    "this that these those am is are was were be been being have has had having do does did "
    "doing a an the and but if or because as until while of at by for with about against between "
    "into through during before after above below to from up down in out on off over under again "
    "further then once here there when where why how all any both each few more most other some "
    "such no nor not only own same so than too very s t can will just don should now"
).split()

# News types counted as reliable and as fake.
RELIABLE = "reliable"
FAKE = "fake"
FAKE_TYPES = [
    "fake", "satire", "bias", "conspiracy", "state", "junksci", "hate", "clickbait",
    "unreliable", "political",
]

# Columns of the headerless statement files, in file order.
STATEMENT_COLUMNS = [
    "id", "type", "content", "subjects", "speaker", "job_title", "state", "party",
    "barely_true", "false", "half_true", "mostly_true", "pants_fire", "context",
]
STATEMENT_COUNT_COLUMNS = ["barely_true", "false", "half_true", "mostly_true", "pants_fire"]
