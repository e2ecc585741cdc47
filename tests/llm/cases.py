"""Inputs that several tests share."""

SF_DIR = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators use inside, or give to results: inputs may have them too.
CLASHING = ["kept", "component_id", "size", "number", "row", "score", "h", "token", "taken", "shard", "hash", "words",
            "rep", "stratum", "start", "digest", "bits", "places", "near", "bucket", "held_out", "first_doc_id", "u"]


def prose(rnd, words, vocabulary=400):
    return " ".join(f"w{int(vocabulary * rnd.random() ** 2)}" for _ in range(words))
