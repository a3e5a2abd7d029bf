"""Plain Python versions of the contracts, and small awkward tables."""

import hashlib
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def documents(spark, texts, lang="en", source="s"):
    """A documents table; ids count from 0."""
    return spark.createDataFrame([(i, t, lang, source, len(t or "")) for i, t in enumerate(texts)], DOCS)


def clash(docs, *names):
    """``docs`` with further columns whose names an operator uses itself."""
    from pyspark.sql import functions as F
    return docs.withColumns({n: F.lit("mine") for n in names})


def exact_groups(rows):
    """{doc_id: (keep_id, group_size, kept, sha)} for distinct ids."""
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text or ""), []).append((-len(text or ""), doc_id))
    out = {}
    for norm, members in groups.items():
        keep = min(members)[1]
        for _, doc_id in members:
            out[doc_id] = (keep, len(members), doc_id == keep, hashlib.sha256(norm.encode()).hexdigest())
    return out


def base_rules(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    many = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if many[w] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"),
            len(lines) - len(set(lines)), len(covered), failed)
