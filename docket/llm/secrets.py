"""Secret scans: candidates by pattern, false positives removed by a random forest (operator 5).

Candidates are long runs with digits or a known prefix, whole key blocks, values after
a secret's name and passwords in URLs.
A forest judges each by its length, character transitions, dictionary coverage, path
and neighbouring words; it is trained from labelled findings. The dictionary is that of
the corpus: the words that most of its documents have. Everything that touches
documents is a DataFrame function: features are columns, and the trees are arrays
walked by higher-order functions. Nothing is exploded, joined or shuffled.
"""

from __future__ import annotations

import json
import pkgutil
import random
import string
import uuid
from collections.abc import Callable
from dataclasses import dataclass, replace

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import unused

#: Words that name a secret, words that name something public, common words inside identifiers.
SECRET_WORDS = "token secret password passwd pwd apikey api_key api-key key auth authorization bearer credential credentials private".split()
PUBLIC_WORDS = "commit sha sha1 sha256 md5 checksum digest hash etag uuid guid revision rev build version id isbn serial order invoice phone card".split()
COMMON_WORDS = "the and for with this that from test data file image user config name value list item page index main node type text time date path home local public static content article title example sample default module class function string number object array select update delete insert create server client request response error message version system service account project package library python java script style".split()
PREFIXES = ["AKIA", "ASIA", "ghp_", "gho_", "ghs_", "github_pat_", "xoxb-", "xoxp-", "sk_live_", "rk_live_", "AIza", "eyJ", "-----BEGIN"]
PLACEHOLDERS = "example changeme xxxx placeholder your dummy redacted sample 00000000 12345678 abcdefgh".split()

_RUN = r"[A-Za-z0-9+/_.\-]"
_NAMES = "password|passwd|pwd|secret|token|api[_-]?key"
_KEY = r"[A-Z0-9 ]{0,30}PRIVATE KEY(?: BLOCK)?-----"
#: After a secret's name, quoted or not, and = or :.
_NAMED = rf"""(?<=(?i:{_NAMES})[\\"']{{0,2}}\s{{0,3}}[:=]\s{{0,3}}"""
#: A private key from BEGIN to END (without END: its header and the lines that can be its body); a value of 8 or more
#: after a secret's name, quoted or not; a password in a URL; a run of 16 or more with a digit or a known prefix.
CANDIDATE = (
    rf"-----BEGIN {_KEY}(?:[^\-]*+(?:-(?!----)[^\-]*+)*+-----END {_KEY}|(?:(?:\s|\\[nr])+(?:(?:Proc-Type|DEK-Info|Version|Comment): [^\r\n]*+|[A-Za-z0-9+/=]{{16,}}+))*+)"
    rf"""|(?<=["']){_NAMED}["'])[^\s"']{{8,}}"""
    rf"""|(?<=[:=]\s{{0,3}})(?=[^\s"',;]{{8}}){_NAMED})[^\s"',;]{{7,}}[^\s"',;.]"""
    r"""|(?<=:)(?<=://[^\s/:@"']{0,64}:)[^\s/"']+(?=@)"""
    rf"|(?<!{_RUN})(?=[A-Za-z+/_.\-]*+[0-9]|{'|'.join(PREFIXES[:-1])}){_RUN}{{16,}}(?<!\.)={{0,2}}"
)
#: Characters of context on either side.
CONTEXT = 48


def _any(words: list[str]) -> str:
    return "|".join(w.replace("-", r"\-") for w in words)


#: Letters of the shortest word of a dictionary.
SHORTEST = 4


def dictionary(docs: DataFrame, size: int = 3000, text_col: str = "text") -> tuple[str, ...]:
    """The words of SHORTEST letters or more that most documents have, in lower case; at most size, ties by the word.

    All texts count, each once for a word; null and empty texts have none, an empty table gives no words.
    """
    words = F.array_distinct(F.regexp_extract_all(F.lower(F.col(text_col)), F.lit(rf"\p{{L}}{{{SHORTEST},}}"), F.lit(0)))
    counted = docs.select(F.explode(words).alias("w")).groupBy("w").agg(F.count("*").alias("n")).where("n > 1")
    return tuple(sorted(r.w for r in counted.orderBy(F.col("n").desc(), "w").limit(size).collect()))


def features(value: Column, before: Column, after: Column, words: tuple[str, ...] = ()) -> list[Column]:
    """The numbers that the forest sees of a candidate and its context; words: the dictionary."""
    known = F.split(F.lit(" ".join([*COMMON_WORDS, *words])), " ")
    low = F.lower(value)
    n = F.greatest(F.lit(1), F.length(value)).cast("double")

    def share(pattern: str, of: Column = value) -> Column:
        return F.length(F.regexp_replace(of, pattern, "")) / n

    runs = value
    for pattern, mark in (("[0-9]+", "0"), ("[a-z]+", "a"), ("[A-Z]+", "A"), ("[^0aA]+", "-")):
        runs = F.regexp_replace(runs, pattern, mark)
    yes: Callable[[Column], Column] = lambda c: c.cast("double")
    return [
        n,
        share("[^0-9]"),
        share("[^A-Z]"),
        share("[^a-z]"),
        share("[A-Za-z0-9]"),
        F.length(runs) / n,  # character transitions
        F.size(F.array_distinct(F.split(value, ""))) / n,
        share("[^aeiou]", low),
        yes(value.rlike("^[0-9a-f]+$|^[0-9A-F]+$")),
        1 - share(f"({_any(COMMON_WORDS)})", low),  # dictionary coverage, inside of words and by whole ones
        F.aggregate(F.split(low, r"[^\p{L}]+"), F.lit(0), lambda total, w: total + F.when(F.array_contains(known, w), F.length(w)).otherwise(0)) / n,
        share("[^/]"),  # path
        yes(before.rlike(r"(://|/|\\)[^\s\"']*$")),
        yes(before.rlike(rf"(?i)({_any(SECRET_WORDS)})[^A-Za-z0-9]{{0,6}}$")),
        yes(before.rlike(rf"(?i)\b({_any(PUBLIC_WORDS)})[^A-Za-z0-9]{{0,6}}$")),
        yes(before.rlike(r"[=:]\s*[\"']?$")),
        yes(before.rlike(r"=[\"']?$")),
        yes(before.rlike(r"://[^\s/:@]{0,64}:$") & after.startswith("@")),
        yes(value.rlike(r"^[a-z]+$")),
        yes(before.rlike(r"[\"']$") & after.rlike(r"^[\"']")),
        yes(value.rlike(f"^({_any(PREFIXES)})")),
        yes(low.rlike(f"({_any(PLACEHOLDERS)})")),
    ]


@dataclass(frozen=True)
class Forest:
    """Trees end to end: a node's feature (-1: leaf), threshold, children and share of secrets."""

    roots: tuple[int, ...]
    feature: tuple[int, ...]
    threshold: tuple[float, ...]
    left: tuple[int, ...]
    right: tuple[int, ...]
    value: tuple[float, ...]
    depth: int
    words: tuple[str, ...] = ()

    def column(self, of: Column) -> Column:
        """Mean of the trees' leaves for an array of features."""
        feature, threshold, left, right, value = (F.lit(list(x)) for x in (self.feature, self.threshold, self.left, self.right, self.value))

        def walk(root: Column) -> Column:
            def down(at: Column, _: Column) -> Column:
                f = F.get(feature, at)
                return F.when(f < 0, at).when(F.get(of, f) <= F.get(threshold, at), F.get(left, at)).otherwise(F.get(right, at))

            return F.get(value, F.aggregate(F.sequence(F.lit(1), F.lit(self.depth)), root, down))

        return F.aggregate(F.lit(list(self.roots)), F.lit(0.0), lambda total, root: total + walk(root)) / len(self.roots)

    def score(self, x: list[float]) -> float:
        """The same for one row, in plain Python."""
        total = 0.0
        for at in self.roots:
            while self.feature[at] >= 0:
                at = self.left[at] if x[self.feature[at]] <= self.threshold[at] else self.right[at]
            total += self.value[at]
        return total / len(self.roots)


def grow(x: np.ndarray, y: np.ndarray, trees: int = 15, depth: int = 7, least: int = 3, seed: int = 3) -> Forest:
    """Trees on bootstrap samples; each split takes the best Gini gain among a few features drawn at random."""
    rng = np.random.default_rng(seed)
    nodes: list[list] = []

    def split(rows: np.ndarray) -> tuple[int, float] | None:
        best, found = 1e-9, None
        own = y[rows]
        base = len(rows) * (p := own.mean()) * (1 - p)
        for f in rng.choice(x.shape[1], max(2, int(np.sqrt(x.shape[1])) + 1), replace=False):
            order = np.argsort(x[rows, f], kind="stable")
            v, t = x[rows, f][order], own[order].cumsum()
            k = np.arange(1, len(rows))
            a, b = t[:-1], t[-1] - t[:-1]
            impure = a * (1 - a / k) + b * (1 - b / (len(rows) - k))
            impure[(v[1:] == v[:-1]) | (k < least) | (len(rows) - k < least)] = np.inf
            if len(impure) and base - impure.min() > best:
                i = int(impure.argmin())
                best, found = base - impure[i], (int(f), float((v[i] + v[i + 1]) / 2))
        return found

    def build(rows: np.ndarray, level: int) -> int:
        at = len(nodes)
        nodes.append([-1, 0.0, at, at, float(y[rows].mean())])
        if level < depth and 0 < y[rows].mean() < 1 and (found := split(rows)):
            f, t = found
            low = x[rows, f] <= t
            nodes[at][:2] = f, t
            nodes[at][2], nodes[at][3] = build(rows[low], level + 1), build(rows[~low], level + 1)
        return at

    roots = tuple(build(rng.integers(0, len(y), len(y)), 0) for _ in range(trees))
    columns = list(zip(*nodes, strict=True))
    return Forest(roots, *(tuple(c) for c in columns), depth)


def findings(seed: int = 5, each: int = 40) -> list[dict]:
    """Labelled findings: invented secrets and what is often taken for one, each with its neighbours."""
    rnd = random.Random(seed)
    hexes, letters = "0123456789abcdef", string.ascii_letters + string.digits
    draw = lambda chars, n: "".join(rnd.choice(chars) for _ in range(n))
    words = lambda n: [draw("abdeghilmnorstu", rnd.randint(2, 9)) for _ in range(n)]
    out: list[dict] = []

    def add(label: int, value: str, before: str, after: str = "") -> None:
        prose = " ".join(words(rnd.randint(0, 4)))
        if rnd.random() < 0.2:
            before, value = before.upper(), value.upper() if set(value.lower()) <= set(hexes) else value
        after = after or rnd.choice(["", " ", ".", ",", "!!", "***"])
        out.append({"value": value, "before": f"{prose} {before}"[-CONTEXT:], "after": f"{after} {' '.join(words(2))}"[:CONTEXT], "label": label})

    for _ in range(each):
        named = rnd.choice(["token", "secret", "password", "api_key", "apikey", "auth", "private key", "access token", "client_secret"])
        glue, quote = rnd.choice([" = ", "=", ": ", ":", " is "]), rnd.choice(['"', "'", ""])
        for value in (draw(hexes, rnd.choice([32, 40, 64])), draw(hexes, 40), draw(letters, rnd.randint(20, 48)), draw(letters + "+/", 40)):
            add(1, value, named + glue + quote, quote)
        add(1, "AKIA" + draw(string.ascii_uppercase + string.digits, 16), rnd.choice(["", named + glue]))
        add(1, rnd.choice(["ghp_", "gho_"]) + draw(letters, 36), rnd.choice(["", named + glue, "clone with "]))
        add(1, "sk_live_" + draw(letters, 24), rnd.choice(["", named + glue + quote]), quote)
        add(1, "eyJ" + draw(letters, 20) + ".eyJ" + draw(letters, 40) + "." + draw(letters + "-_", 43), rnd.choice(["Bearer ", named + glue]))
        add(1, "-----BEGIN RSA PRIVATE KEY-----", "")
        public = rnd.choice(PUBLIC_WORDS)
        for value in (draw(hexes, 40), draw(hexes, 32), draw(hexes, 64)):
            add(0, value, public + rnd.choice([" ", ": ", "=", ":", ' "']))
        add(0, draw(hexes, 40), rnd.choice(["", "tree/", "https://host.example/commit/", "objects/"]))
        add(0, str(uuid.UUID(int=rnd.getrandbits(128))), rnd.choice(["", "id: ", "uuid ", 'guid="']))
        add(0, draw(string.digits, rnd.randint(16, 20)), rnd.choice(["", "card ", "phone ", "order ", "number: "]))
        add(0, f"{rnd.randint(1990, 2030)}-{rnd.randint(1, 12):02}-{rnd.randint(1, 28):02}T{rnd.randint(0, 23):02}:00", rnd.choice(["", "time: "]).replace(":", ""))
        add(0, "/".join([*words(3), f"{rnd.choice(COMMON_WORDS)}{rnd.randint(1, 99)}"]), rnd.choice(["/usr/", "https://", "path: ", ""]))
        add(0, "-".join([*words(3), str(rnd.randint(1, 9999))]), rnd.choice(["https://www.example.com/", "", "see "]))
        add(0, "_".join([rnd.choice(COMMON_WORDS), rnd.choice(COMMON_WORDS), *words(1), str(rnd.randint(1, 99))]), rnd.choice(["", "def ", "key: "]))
        add(0, "".join(w.title() for w in [rnd.choice(COMMON_WORDS), *words(2)]) + str(rnd.randint(1, 999)), rnd.choice(["", "class "]))
        add(0, "".join(words(4)) + str(rnd.randint(0, 99)), "")
        add(0, rnd.choice(["your_token_here_1234", "xxxxxxxxxxxxxxxx1", "changeme12345678", "example-secret-0000", "0000000000000000", "1234567890123456", "placeholder_key_1"]), named + glue + quote, quote)
        add(0, "iVBORw0KGgoAAAANSUhEUg" + draw(letters + "+/", 40), "data:image/png;base64,")
        add(0, "www." + ".".join(words(2)) + f".example.com/{rnd.randint(1, 9999)}", rnd.choice(["http://", ""]))
        add(0, f"{draw('abcdemnorst', 8)}.{rnd.randint(1, 99)}@mail{rnd.randint(1, 9)}.example.com".split("@")[0] + draw("abc", 6), "mail ")
        add(0, "=" * rnd.randint(16, 30) + "1", "")
        add(0, ".".join(draw(string.digits, 3) for _ in range(5)), rnd.choice(["", "version "]))
        kind = rnd.choice(["RSA PRIVATE KEY", "EC PRIVATE KEY", "PRIVATE KEY", "OPENSSH PRIVATE KEY", "ENCRYPTED PRIVATE KEY", "PGP PRIVATE KEY BLOCK"])
        body = "\n".join(draw(letters + "+/", 64) for _ in range(rnd.randint(2, 30)))
        add(1, f"-----BEGIN {kind}-----\n{body}\n-----END {kind}-----", "")
        add(1, f"-----BEGIN {kind}-----\n{body}", "")
        named = rnd.choice(["password", "DB_PASSWORD", "passwd", "pwd", "client_secret", "token", "api_key"])
        chosen = lambda: draw(letters, rnd.randint(2, 6)) + draw(string.ascii_letters, 4) + draw(string.digits, rnd.randint(1, 4)) + draw("!@#$%&*?^+", rnd.randint(0, 2)) + draw(letters, rnd.randint(0, 4))
        for glue in ("=", " = ", ": "):
            add(1, chosen(), named + glue)
        add(1, chosen(), rnd.choice(["{", ""]) + f'"{named}": "', '"')
        add(1, chosen(), rnd.choice(["https", "postgres", "redis", "ftp"]) + f"://{words(1)[0]}:", "@" + words(1)[0])
        for value in (words(1)[0] + rnd.choice(["()", "(self)", ".get()"]), "".join(words(2)) + "ing", rnd.choice(["required", "undefined", "optional", "Optional[str]", "string", "process.env.TOKEN", "os.environ", "${DB_PASSWORD}", "getpass.getpass()", "<password>", "********", "your_password", "changeme1"])):
            add(0, value, named + rnd.choice(["=", " = ", ": "]))
        add(0, "".join(words(2)) + "er", f'"{named}": "', '"')
        add(0, rnd.choice(["password", "your_password", "********", "$PASSWORD", "<password>", "${PASS}"]), f"https://{words(1)[0]}:", "@" + words(1)[0])
    return out


def written_findings() -> list[dict]:
    """Labelled findings that were written by hand: what people choose as passwords, and prose and code beside a secret's name."""
    return json.loads(pkgutil.get_data(__package__, "findings.json"))


def learn(spark: SparkSession, labelled: list[dict] | None = None, words: tuple[str, ...] = (), **kw) -> Forest:
    """A forest from labelled findings (value, before, after, label); their features are computed by Spark.

    The list is the training set and bounded by its author; by default it is findings() and
    written_findings(), these eight times. words: the corpus' dictionary.
    """
    labelled = findings() + 8 * written_findings() if labelled is None else labelled
    kind = "array<struct<value:string,before:string,after:string,label:int>>"
    rows = spark.range(1).select(F.explode(F.from_json(F.lit(json.dumps(labelled)), kind)).alias("r")).select("r.*")
    got = rows.select(F.array(*features(F.col("value"), F.col("before"), F.col("after"), words)).alias("x"), "label").collect()
    return replace(grow(np.array([r.x for r in got]), np.array([r.label for r in got], float), **kw), words=words)


def forest_for(docs: DataFrame, text_col: str = "text") -> Forest:
    """A forest with the dictionary of docs."""
    return learn(docs.sparkSession, words=dictionary(docs, text_col=text_col))


def _judged(text: Column, forest: Forest) -> Column:
    """Array of (start, value, score, rest): every candidate, and the text up to the next one."""
    parts = F.transform(F.array(F.struct(text.alias("t"), F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0)).alias("c"))), lambda x: F.struct(x["c"].alias("c"), F.when(F.size(x["c"]) > 0, F.split(x["t"], CANDIDATE, -1)).otherwise(F.array(x["t"])).alias("p")))

    def seen(x: Column) -> Column:
        one = F.transform(
            F.when(F.size(x["c"]) > 0, F.sequence(F.lit(0), F.size(x["c"]) - 1)).otherwise(F.array().cast("array<int>")),
            lambda i: F.struct(
                F.get(x["c"], i).alias("value"),
                F.array(*features(F.get(x["c"], i), F.right(F.get(x["p"], i), F.lit(CONTEXT)), F.substring(F.get(x["p"], i + 1), 1, CONTEXT), forest.words)).alias("x"),
                F.length(F.get(x["p"], i)).alias("gap"),
                F.get(x["p"], i + 1).alias("rest"),
            ),
        )
        judged = F.transform(one, lambda c: F.struct(c["value"].alias("value"), forest.column(c["x"]).alias("score"), c["gap"].alias("gap"), c["rest"].alias("rest")))
        kind = "array<struct<start:int,value:string,score:double,rest:string>>"
        start = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("out"))

        def place(acc: Column, c: Column) -> Column:
            at = acc["at"] + c["gap"]
            found = F.struct(at.alias("start"), c["value"].alias("value"), c["score"].alias("score"), c["rest"].alias("rest"))
            return F.struct((at + F.length(c["value"])).alias("at"), F.concat(acc["out"], F.array(found).cast(kind)).alias("out"))

        return F.struct(F.get(x["p"], F.lit(0)).alias("head"), F.aggregate(judged, start, place, lambda acc: acc["out"]).alias("found"))

    return F.get(F.transform(parts, seen), F.lit(0))


def scan(docs: DataFrame, forest: Forest, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_candidates, n_secrets, secrets) for every row; secrets: array of (start, value, score).

    start counts characters from 0. Null and empty texts have no candidates; repeated
    rows are judged alike; an empty table gives no rows; other columns are not read.
    One pass, no shuffle.
    """
    found = _judged(F.coalesce(F.col(text_col), F.lit("")), forest)["found"]
    secrets = F.transform(F.filter(F.col("_f"), lambda c: c["score"] >= threshold), lambda c: F.struct(c["start"].alias("start"), c["value"].alias("value"), c["score"].alias("score")))
    out = docs.select(F.col(id_col).alias("_i"), found.alias("_f")).select(F.col("_i").alias(id_col), F.size("_f").alias("n_candidates"), secrets.alias("secrets"))
    return out.select(id_col, "n_candidates", F.size("secrets").alias("n_secrets"), "secrets")


def redact(docs: DataFrame, forest: Forest, threshold: float = 0.5, mark: str = "[SECRET]", text_col: str = "text", size_col: str | None = "n_chars") -> DataFrame:
    """docs with each secret replaced by mark, all rows and columns kept.

    size_col, if there, is set to the new length where a text changed. Null texts stay null, empty
    ones empty; repeated rows change alike; an empty table gives no rows; columns may have any names.
    """
    text = F.col(text_col)
    judged = F.transform(F.array(_judged(text, forest)), lambda j: F.concat(j["head"], F.array_join(F.transform(j["found"], lambda c: F.concat(F.when(c["score"] >= threshold, F.lit(mark)).otherwise(c["value"]), c["rest"])), "")))
    new = F.when(text.isNotNull(), F.get(judged, F.lit(0)))
    name = unused(docs, "new")
    out = docs.withColumn(name, new)
    if size_col in docs.columns:
        out = out.withColumn(size_col, F.when(F.col(name) != text, F.length(name).cast(docs.schema[size_col].dataType)).otherwise(F.col(size_col)))
    return out.withColumn(text_col, F.col(name)).drop(name)
