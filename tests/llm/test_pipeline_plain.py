"""The pipeline's stages on the smallest table, against plain Python after each stage."""

import hashlib
import math
from collections import Counter, defaultdict

import numpy as np

from groovemill.llm import tokens

from .test_search import DATA
from .test_tables import WORD, dedup, fill, rules
from .test_texts import closure, shingle_set


def good(rows):
    """Rows that pass the base rules, of hosts that the beta prior leaves."""
    failed, hosts = {}, defaultdict(list)
    for i, (text, source, _) in rows.items():
        n, _, _, _, repeated = rules(text or "")
        failed[i] = n < 20 or 100 * repeated > 30 * n
        hosts[source].append(failed[i])
    every = [f for x in hosts.values() for f in x]
    total, mean = len(every), sum(every) / len(every)
    spread, others = mean * (1 - mean), len(hosts) - 1
    varies = sum(len(x) * (sum(x) / len(x) - mean) ** 2 for x in hosts.values()) / spread if spread else 0.0
    free = total - sum(len(x) ** 2 for x in hosts.values()) / total - others
    share = (varies - others) / free if free > 0 else 0.0
    strength = min(max(1 / share - 1, 1.0), total) if share > 0 else total
    kept = {h: (sum(x) + mean * strength) / (len(x) + strength) <= 0.5 for h, x in hosts.items()}
    return {i: r for i, r in rows.items() if not failed[i] and kept[r[1]]}


def copies(rows):
    """How often the mix takes each document."""
    size = {i: len(WORD.findall(r[0] or "")) for i, r in rows.items()}
    sources = sorted({r[1] for r in rows.values()}, key=lambda s: (s is None, s or ""))
    own = [sorted((i for i in rows if rows[i][1] == s), key=lambda i: hashlib.md5(f"mix-1:{i}".encode()).hexdigest()) for s in sources]
    totals, out = [sum(size[i] for i in x) for x in own], Counter()
    for x, total, target in zip(own, totals, fill(totals, [1 + k % 3 for k in range(len(own))], 3), strict=True):
        rate = target / total if total else 0
        left = math.floor((rate - math.floor(rate)) * total + 0.5)
        for i in x:
            more = min(size[i], left)
            left -= more
            if size[i]:
                out[i] += math.floor((math.floor(rate) * size[i] + more) / size[i] + 0.5)
    return +out


def test_stages_equal_plain_python(spark):
    from tokenizers import Tokenizer

    import corpus_pipeline

    stages = dict(corpus_pipeline.STAGES)
    first = spark.read.parquet(f"{DATA}/documents.parquet")

    def step(name, df):
        out = spark.createDataFrame(stages[name](spark, df, DATA).collect(), df.schema)
        return out, Counter((r.doc_id, r.text, r.source, r.n_chars) for r in out.collect())

    rows = good({r.doc_id: (r.text, r.source, r.n_chars) for r in first.collect()})
    now, got = step("quality_rules", first)
    assert got == Counter((i, *r) for i, r in rows.items()) and rows

    new = dict(dedup([(i, r[0]) for i, r in rows.items()], 20, 3).keys())
    rows = {i: (new[i], s, n if new[i] == x else len(new[i])) for i, (x, s, n) in rows.items()}
    now, got = step("line_dedup", now)
    assert got == Counter((i, *r) for i, r in rows.items())

    label = closure({i: shingle_set(r[0]) for i, r in rows.items()})
    rows = {i: r for i, r in rows.items() if label[i] == i}
    now, got = step("near_duplicates", now)
    assert got == Counter((i, *r) for i, r in rows.items())

    times = copies(rows)
    now, got = step("mixing", now)
    assert got == Counter({(i, *rows[i]): n for i, n in times.items()})

    fresh, want, covered = Tokenizer.from_file(tokens.vocabulary()), Counter(), Counter()
    for i, n in times.items():
        for k, x in enumerate([*fresh.encode(rows[i][0], add_special_tokens=False).ids, 0]):
            want[i, k, x] += n
    for r in stages["packing"](spark, now, DATA).collect():
        covered.update((r.doc_id, r.start + k, x) for k, x in enumerate(np.frombuffer(r.ids, "<u4").tolist()))
    assert covered == want
