"""Secret scans: candidates by pattern, false positives removed by a random
forest. DataFrame operations and MLlib (JVM) only.

A candidate is a run of at least ``MIN_LENGTH`` credential characters that
holds a digit or is assigned to a credential's name; a word gives each of its
runs. Its features: length, the shares of the transitions between character
classes, variety, digit and dictionary shares, published formats, the path of
its document, its place in a URL and the words around it. The forest is trained
from labelled findings.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import store

MIN_LENGTH = 8
#: A run of credential characters, and what may stand between ``=`` and a value.
RUN = r"[A-Za-z0-9+/_\-]{%d,}" % MIN_LENGTH
OPENS = r"[\s\\\"'`(\[{<]*$"
#: Characters in front of and behind a run that are looked at inside long words.
CONTEXT, TRAIL = 256, 8
#: Bound of the labelled findings a forest is fitted on.
MAX_FINDINGS = 20_000
TREES, DEPTH = 30, 6

# Words that name credentials, and words of identifiers and prose.
CREDENTIAL_WORDS = ["password", "passwd", "pwd", "secret", "token", "apikey", "api_key", "access_key", "private_key",
                    "auth", "bearer", "credential", "credentials", "aws_access_key_id", "aws_secret_access_key"]
DICTIONARY = ["about", "account", "address", "admin", "after", "album", "article", "author", "blog", "book", "build",
              "category", "change", "class", "client", "code", "comment", "config", "content", "count", "data", "date",
              "default", "device", "document", "email", "error", "event", "example", "file", "first", "forum", "function",
              "group", "home", "html", "http", "https", "image", "index", "info", "item", "last", "link", "list", "login",
              "mail", "main", "message", "model", "month", "name", "news", "number", "object", "order", "page", "path",
              "phone", "photo", "post", "product", "public", "query", "release", "report", "search", "server", "service",
              "session", "source", "start", "status", "string", "style", "system", "table", "test", "text", "time",
              "title", "topic", "type", "update", "user", "value", "version", "video", "view", "week", "world", "year"]
# Published formats, from the start of the value.
PUBLISHED = [
    r"(?:AKIA|ASIA|ABIA|ACCA)[0-9A-Z]{16}$", r"gh[pousr]_[A-Za-z0-9]{16,}", r"github_pat_[A-Za-z0-9_]{16,}", r"glpat-[A-Za-z0-9_\-]{16,}",
    r"(?:sk|rk)_(?:live|test)_[A-Za-z0-9]{10,}", r"whsec_[A-Za-z0-9+/]{16,}", r"sk-(?:proj-|ant-)?[A-Za-z0-9_\-]{20,}",
    r"xox[abeoprs]-[A-Za-z0-9\-]{10,}", r"xapp-[A-Za-z0-9\-]{10,}", r"AIza[A-Za-z0-9_\-]{35}", r"npm_[A-Za-z0-9]{20,}",
    r"pypi-[A-Za-z0-9_\-]{16,}", r"hf_[A-Za-z0-9]{20,}", r"do[oprt]_v1_[0-9a-f]{32,}", r"shp(?:at|ca|pa|ss)_[0-9a-fA-F]{32}",
    r"SK[0-9a-f]{32}$", r"key-[0-9a-f]{32}$", r"dapi[0-9a-f]{32}", r"lin_api_[A-Za-z0-9]{20,}", r"eyJ[A-Za-z0-9_\-]{10,}"]
#: Classes of a value's characters (lower, upper, digit, other) and their ordered pairs.
CLASSES = "aA0_"
PAIRS = [x + y for x in CLASSES for y in CLASSES]
FEATURES = ["length", "transitions", "variety", "digit_share", "letter_share", "upper_share", "hex_share",
            "dictionary_share", "credential_before", "credential_after", "assigned", "quoted", "example_path",
            "published", "scheme", "url_password", *[f"pair_{i}" for i in range(len(PAIRS))]]

# Contexts of labelled examples; {v} is a value made by ``_made``.
SECRET_CONTEXTS = ["{v}", "use {v} for the call", "deploy with {v} today", "'{v}'", "<code>{v}</code>"]
#: (start, alphabet, length of the rest) of published formats.
SECRET_SHAPES = [
    ("AKIA", "U", 16), ("ASIA", "U", 16), ("ghp_", "b", 36), ("gho_", "b", 36), ("github_pat_", "b", 40), ("glpat-", "b", 20),
    ("sk_live_", "b", 24), ("rk_live_", "b", 24), ("whsec_", "b", 32), ("sk-proj-", "b", 40), ("xoxb-", "b", 40), ("xapp-", "b", 40),
    ("AIza", "b", 35), ("npm_", "b", 36), ("pypi-", "b", 40), ("hf_", "b", 34), ("dop_v1_", "h", 64), ("shpat_", "h", 32),
    ("SK", "h", 32), ("key-", "h", 32), ("dapi", "h", 32), ("lin_api_", "b", 40), ("eyJ", "b", 60)]
SECRET_LINES = ["password = {b}", "\"api_key\": \"{h}\"", "token: {b}", "Authorization: Bearer {b}",
                "postgres://app:{b}@db.local:5432/x", "secret => '{b}'", "aws_secret_access_key={b}"]
PLAIN_LINES = ["commit {h} merged", "see /assets/{h}.js", "checksum {h}", "id {u}", "session-{d} closed", "order {d} shipped",
               "on 20240131T101500Z", "call {d} now", "release-2024-build{d}", "user{d}@example.org", "https://example.org/{h}/index.html",
               "img_{d}_large", "ISBN {d}", "uuid {u} found", "class Model{d}Config", "page{d}version2"]


def _assigns(credential_words: Sequence[str]) -> str:
    """Pattern of a credential's name, quoted or not, with what assigns it."""
    names = "|".join(w.replace("_", "[_-]?") for w in sorted(credential_words, key=len, reverse=True))
    return r"(?i)(?:%s)s?(?:[_-]?key)?[\\\"'`\])]*\s*(?:=>|:=|[=:])" % names


def candidates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source",
               credential_words: Sequence[str] = tuple(CREDENTIAL_WORDS)) -> DataFrame:
    """``id_col, position, ordinal, value, key, before, after, lead, trail, word,
    path`` of every candidate; ``position`` counts words from 0, ``ordinal`` the runs of
    a word. ``before`` holds the two words in front, ``after`` the next one (from
    a word's second run on their nearest ``CONTEXT`` characters, so a word of
    many runs does not repeat long neighbours). ``key`` is the name that is
    assigned the run inside the word, ``lead`` the text from the run in front of
    it, ``trail`` the ``TRAIL`` characters behind, ``word`` all three. Words are separated by
    white space. A run without a digit counts where a credential's name is
    assigned it."""
    path = F.col(path_col).cast("string") if path_col else F.lit(None).cast("string")
    words = F.split(F.col(text_col), r"\s+")
    assigns = _assigns(credential_words)
    named = F.col(text_col).rlike(assigns)
    # a generator keeps the split words from being computed again per word
    d = df.where(F.col(text_col).rlike("[0-9]") | named).select(
        F.col(id_col).alias("__id"), path.alias("__path"), named.alias("named"), F.explode(F.array(words)).alias("w"))
    at = lambda i: F.when((i >= 0) & (i < F.size("w")), F.get("w", i)).otherwise(F.lit(""))
    front = lambda i: F.concat_ws(" ", at(i - 2), at(i - 1))
    found = F.filter(F.transform("w", lambda x, i: F.struct(i.alias("i"), x.alias("x"))), lambda s: s["x"].rlike(
        RUN) & (s["x"].rlike("[0-9]") | (F.col("named") & F.concat_ws(" ", front(s["i"]), s["x"]).rlike(assigns))))
    row = F.transform(found, lambda s: F.struct(
        s["i"].alias("i"), s["x"].alias("x"), front(s["i"]).alias("b"), at(s["i"] + 1).alias("a")))
    d = d.select("__id", "__path", F.explode(row).alias("c"))
    # every run with the text between it and the run in front; \G leaves a rest without a run after one look
    part = lambda n: F.regexp_extract_all("c.x", F.lit(r"(?s)\G(.*?)(%s={0,2})(?=(.{0,%d}))" % (RUN, TRAIL)), F.lit(n))
    d = d.select("__id", "__path", "c.i", "c.b", "c.a", F.explode(F.array(F.struct(
        part(1).alias("lead"), part(2).alias("value"), part(3).alias("trail")))).alias("p"))
    near = lambda k, whole, cut: F.when(k == 0, whole).otherwise(cut(whole, F.lit(CONTEXT)))
    runs = F.transform("p.value", lambda v, k: F.struct(
        k.alias("k"), v.alias("v"), F.get("p.trail", k).alias("trail"), F.concat(F.when(
            k > 0, F.right(F.get("p.value", k - 1), F.lit(CONTEXT))).otherwise(F.lit("")), F.get("p.lead", k)).alias("lead"),
        near(k, F.col("b"), F.right).alias("b"), near(k, F.col("a"), F.left).alias("a")))
    d = d.select("__id", "__path", "i", F.explode(runs).alias("r"))
    lead, value = F.right("r.lead", F.lit(CONTEXT)), F.col("r.v")
    key = r"([A-Za-z_][A-Za-z0-9_.\-]*)[\\\"'`\])]*(?:=>|:=|[=:])[\\\"'`(\[{<]*$"
    d = d.where(value.rlike("[0-9]") | F.right(F.concat_ws(" ", "r.b", lead), F.lit(CONTEXT)).rlike(assigns + OPENS))
    return d.select(
        F.col("__id").alias(id_col), F.col("i").cast("long").alias("position"), F.col("r.k").cast("long").alias("ordinal"),
        value.alias("value"), F.lower(F.regexp_extract(lead, key, 1)).alias("key"), F.col("r.b").alias("before"),
        F.col("r.a").alias("after"), F.col("r.lead").alias("lead"), F.col("r.trail").alias("trail"),
        F.concat("r.lead", value, "r.trail").alias("word"), F.col("__path").alias("path"))


def _made(start: str, alphabet: str, n: int, salt: int) -> str:
    """A value of a published shape, from a hash: the same in every run."""
    import hashlib
    letters = {"U": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "h": "0123456789abcdef", "d": "0123456789",
               "b": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"}[alphabet]
    body = hashlib.shake_256(f"{start}{salt}".encode()).digest(n)
    return start + "".join(letters[x % len(letters)] for x in body)


def example_lines(each: int = 6) -> list[tuple[int, str]]:
    """(label, line): ``each`` lines of every published shape, assignment and
    hard negative, so that a forest knows formats that a corpus lacks."""
    out = []
    for i in range(each):
        for k, (start, alphabet, n) in enumerate(SECRET_SHAPES):
            out.append((1, SECRET_CONTEXTS[(i + k) % len(SECRET_CONTEXTS)].replace("{v}", _made(start, alphabet, n, i))))
        for label, lines in ((1, SECRET_LINES), (0, PLAIN_LINES)):
            for line in lines:
                h = _made("", "h", 40 if i % 2 else 64, 31 * i + len(line))
                u = "-".join((h[:8], h[8:12], h[12:16], h[16:20], h[20:32]))
                out.append((label, line.replace("{h}", h).replace("{u}", u).replace("{d}", _made("", "d", 8 + i, len(line))).replace(
                    "{b}", _made("", "b", 16 + 4 * i, len(line)))))
    return out


def examples(spark, each: int = 6) -> DataFrame:
    """``example_lines`` as labelled findings."""
    lines = spark.createDataFrame(example_lines(each), "label int, text string")
    return candidates(lines, "label", "text", None)


def _share(pattern: str, text: Column = None) -> Column:
    v = F.col("value") if text is None else text
    return 1 - F.length(F.regexp_replace(v, pattern, "")) / F.length("value")


def with_features(cand: DataFrame, credential_words: Sequence[str] = tuple(CREDENTIAL_WORDS),
                  dictionary: Sequence[str] = tuple(DICTIONARY)) -> DataFrame:
    """The candidates with the columns ``FEATURES`` (doubles)."""
    named = r"(?i)(^|[^a-z])(%s)s?([^a-z]|$)" % "|".join(sorted(credential_words, key=len, reverse=True))
    words = "|".join(sorted(dictionary, key=len, reverse=True))
    v = F.col("value")
    classes = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(
        v, "[a-z]", "a"), "[A-Z]", "A"), "[0-9]", "0"), "[^aA0]", "_")
    runs = F.length(F.regexp_replace(classes, r"(.)\1+", "$1"))
    around = F.concat_ws(" ", F.col("before"), F.col("key"))
    f = {
        "length": F.length(v), "transitions": (runs - 1) / F.greatest(F.length(v) - 1, F.lit(1)),
        "variety": F.size(F.array_distinct(F.split(v, ""))) / F.length(v), "digit_share": _share("[0-9]"),
        "letter_share": _share("[A-Za-z]"), "upper_share": _share("[A-Z]"), "hex_share": _share("[0-9a-f]"),
        "dictionary_share": _share(words, F.lower(v)), "credential_before": around.rlike(named),
        "credential_after": F.col("after").rlike(named), "assigned": F.concat_ws(" ", "before", "word").rlike("[=:]"),
        "quoted": F.col("word").rlike("[\"'`]"),
        "example_path": F.coalesce(F.col("path").rlike(r"(?i)(^|[/_.\-])(tests?|examples?|samples?|mocks?|docs?)([/_.\-]|$)"), F.lit(False)),
    }
    front = _front()
    f |= {"published": v.rlike("^(?:%s)" % "|".join(PUBLISHED)) | _prefixed(), "scheme": front.rlike(SCHEME),
          "url_password": _in_url()}
    f |= {f"pair_{i}": F.regexp_count(classes, F.lit(f"{p[0]}(?={p[1]})")) / F.greatest(F.length(v) - 1, F.lit(1))
          for i, p in enumerate(PAIRS)}
    return cand.withColumns({k: f[k].cast("double") for k in FEATURES})


SCHEME = r"(?i)(?:^|[^a-z])(?:bearer|basic)[\s\"'`]+$"


def _front() -> Column:
    """What stands in front of a run, the words before it included."""
    return F.right(F.concat_ws(" ", "before", F.right("lead", F.lit(CONTEXT))), F.lit(CONTEXT))


def _prefixed() -> Column:
    return F.right("lead", F.lit(CONTEXT)).rlike(r"(?:^|[^A-Za-z0-9])(?:SG\.|ya29\.)$")


def _in_url() -> Column:
    return F.right("lead", F.lit(CONTEXT)).rlike("//[^/@:]*:$") & F.col("trail").startswith("@")


def known_format(value: str = "value", credential_words: Sequence[str] = tuple(CREDENTIAL_WORDS),
                 dictionary: Sequence[str] = tuple(DICTIONARY)) -> Column:
    """Label of a finding in a corpus without audited ones. 1: a published
    format, a password inside a URL, or a value of mixed letters and digits
    that is assigned to a credential's name or follows a scheme of
    authorization. 0: what a rule proves to be none, not assigned to such a
    name: dates, card, phone and other numbers, dictionary words with numbers,
    the local part of an e-mail address, hashes in paths. NULL: neither."""
    v = F.col(value)
    lead, trail = F.right("lead", F.lit(CONTEXT)), F.col("trail")
    front = _front()
    named = front.rlike(_assigns(credential_words) + OPENS)
    mixed = v.rlike("[A-Za-z]") & v.rlike("[0-9]")
    scheme = front.rlike(SCHEME) & (F.length(v) >= 16)
    secret = (v.rlike("^(?:%s)" % "|".join(PUBLISHED)) | _prefixed()
              | _in_url() | F.col("before").rlike("PRIVATE KEY-----$")
              | ((named | scheme) & mixed))
    words = "|".join(sorted(dictionary, key=len, reverse=True))
    none = (~v.rlike("[A-Za-z]") | v.rlike(r"^(?:19|20)\d\d[-/]?(?:0[1-9]|1[0-2])[-/]?(?:0[1-9]|[12]\d|3[01])(?:T\d{2,6}Z?)?$")
            | (F.regexp_replace(F.lower(v), r"(?:%s)s?|[0-9/_\-]" % words, "") == "") | (trail.rlike(r"^@[A-Za-z0-9]") & ~lead.endswith(":"))
            | v.rlike(r"/(?:[^/]+[._\-])?(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64})(?:$|[/._\-])"))
    return F.when(secret, 1.0).when(none & ~named & ~scheme, 0.0)


def _vectors(df: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=FEATURES, outputCol="__features").transform(df)


def fit(findings: DataFrame, label_col: str = "label", max_findings: int = MAX_FINDINGS,
        seed: int = 7) -> RandomForestClassificationModel | float:
    """Fit on labelled findings (``with_features`` and a 0/1 label), each
    distinct value with its words and label once. Of more than ``max_findings``
    half are taken of each label, or all where a label has fewer and the
    remainder from the other, in the order of a hash of value and words.
    Without both labels the result is the one probability there is (0.0 when
    empty).

    The forest is saved and loaded: a fitted one holds its training summary and
    by it the session, which no task can take once a frame was observed in it."""
    label = F.col(label_col).cast("double").alias("__label")
    once = ["value", "before", "after", "__label"]
    rows = findings.where(F.col(label_col).isNotNull()).select("value", "before", "after", label, *FEATURES).groupBy(*once).agg(
        F.min(F.struct(*FEATURES)).alias("f"))
    rows = store(rows.select("__label", F.xxhash64("value", "before", "after").alias("__o"), "f.*"), "secret-findings-distinct")
    count = dict(rows.groupBy("__label").count().collect())
    half = max_findings // 2
    parts = [rows.where(F.col("__label") == x).orderBy("__o", *FEATURES).limit(
        min(n, max(half, max_findings - (sum(count.values()) - n)))) for x, n in sorted(count.items())]
    if not parts:
        return 0.0
    rows = store(reduce(DataFrame.unionByName, parts), "secret-findings")
    if len(count) < 2:
        return float(next(iter(count)))
    model = RandomForestClassifier(featuresCol="__features", labelCol="__label", probabilityCol="__p", rawPredictionCol="__raw",
                                   predictionCol="__hit", numTrees=TREES, maxDepth=DEPTH, seed=seed).fit(_vectors(rows))
    path = scratch_path(findings.sparkSession, "secret-forest")
    model.write().save(path)
    return RandomForestClassificationModel.load(path)


def judge(cand: DataFrame, model, threshold: float = 0.5) -> DataFrame:
    """The candidates with ``probability`` and ``is_secret``."""
    if isinstance(model, float):
        out = cand.withColumn("probability", F.lit(model))
    else:
        out = model.transform(_vectors(cand)).withColumn("probability", vector_to_array("__p")[1]).drop(
            "__features", "__raw", "__p", "__hit")
    return out.withColumn("is_secret", F.col("probability") >= threshold)


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source",
         findings: DataFrame | None = None, threshold: float = 0.5) -> DataFrame:
    """``id_col, position, ordinal, length, masked, value_sha256, probability,
    is_secret`` of every candidate; ``is_secret`` false are the false positives
    the forest removes. The value itself is not returned.

    ``findings`` are audited ones (``candidates`` with a column ``label``);
    without them the table's own candidates are labelled by ``known_format``
    and ``examples`` of published formats and hard negatives are added; a
    finding that the rule proves to be a secret stays one whatever the forest
    says, all others are judged by the forest.
    NULL and empty texts have no candidate, a NULL path is no example path,
    repeated rows give their candidates each, an empty table gives no rows. In
    long words a name counts up to ``CONTEXT`` characters in front of a run;
    runs under ``MIN_LENGTH`` characters are no candidates. Equal candidates
    have equal results. Other columns are not read, so their names may clash."""
    cand = with_features(candidates(df, id_col, text_col, path_col))
    if findings is None:
        cand = store(cand.withColumn("label", known_format()), "secret-candidates")
        known = with_features(examples(df.sparkSession)).select("value", "before", "after", "label", *FEATURES)
        labelled = cand.select("value", "before", "after", "label", *FEATURES).unionByName(known)
    else:
        cand = store(cand.withColumn("label", F.lit(None).cast("double")), "secret-candidates")
        labelled = with_features(findings)
    got = judge(cand, fit(labelled), threshold)
    return got.select(id_col, "position", "ordinal", F.col("length").cast("long").alias("length"),
                      F.concat(F.substring("value", 1, 4), F.lit("...")).alias("masked"),
                      F.sha2(F.col("value").cast("binary"), 256).alias("value_sha256"), "probability",
                      (F.col("is_secret") | (F.coalesce("label", F.lit(0.0)) == 1.0)).alias("is_secret"))
