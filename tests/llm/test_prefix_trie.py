"""The trie by sequences of turns themselves."""

import hashlib
import math
import random
import zlib

import pytest

from tidemill.llm import prefix_trie as T

def brute(rows):
    """rows: (conv_id, turn, role, text)"""
    convs={}
    for c,t,r,x in rows: convs.setdefault(c,[]).append((t is not None, t or 0, r or "", x or ""))
    def key(v):
        r,x=v[2],v[3]
        return (v[0],v[1],hashlib.sha256((str(len(r.encode()))+":"+r+x).encode()).digest())
    own={c:[(v[2],v[3]) for v in sorted(vs,key=key)] for c,vs in convs.items()}
    reb={}
    for c,o in own.items():
        if c is None: reb[c]=o; continue
        h=zlib.crc32(str(c).encode())%6
        base=c-int(math.fmod(c,100))
        reb[c]=own.get(base,[])[:h]+o[h:]
    nodes={}
    for c,s in reb.items():
        for d in range(len(s)+1): nodes.setdefault(tuple(s[:d]),[]).append(c)
    kids={}
    for k in nodes:
        if k: kids.setdefault(k[:-1],[]).append(k)
    small=lambda m: min((c for c in m if c is not None),default=None)
    leaves={};saved={}
    for k in sorted(nodes,key=len,reverse=True):
        ch=kids.get(k,[])
        leaves[k]=sum(leaves[x] for x in ch) if ch else 1
        saved[k]=(len(nodes[k])-1)*(len(k[-1][1]) if k else 0)+sum(saved[x] for x in ch)
    out=[]
    for k,m in nodes.items():
        e=sorted((c for c in m if len(reb[c])==len(k)),key=lambda c:(c is not None,c or 0))
        sha=hashlib.sha256(",".join("" if c is None else str(c) for c in e).encode()).hexdigest()
        out.append((small(m),len(k),small(nodes[k[:-1]]) if k else None,len(m),len(kids.get(k,[])),leaves[k],saved[k],sha))
    return sorted(out,key=str)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_the_test_tables(spark, sf):
    source = spark.read.parquet(f"/root/testdata/{sf}/conversations.parquet").select("conv_id", "turn", "role", "text")
    got = sorted(map(tuple, T.op13_prefix_trie(spark, f"/root/testdata/{sf}").collect()), key=str)
    assert got == brute([tuple(r) for r in source.collect()])


def test_long_hot_null_and_repeated(spark):
    rng = random.Random(2)
    rows = []
    for c in [*range(95, 130), -150, -100, 200, 201, 202, None]:
        if c == 100:
            continue  # a base that is absent
        n = 70 if c in (110, 200) else rng.choice([1, 2, 3, 5, 9])
        same = rng.random() < 0.5
        for t in range(n):
            text = "same" if same else rng.choice(["a", "b", "", None])
            rows.append((c, None if rng.random() < 0.05 else t, rng.choice(["user", None]) if not same else "user", text, "x", 1))
    rows += rows[:5]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, name string, depth int")
    got = sorted(map(tuple, T.prefix_trie(df).collect()), key=str)
    assert got == brute([r[:4] for r in rows])


def test_empty(spark):
    assert T.prefix_trie(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).collect() == []


def test_dense_names(spark):
    df = spark.createDataFrame([(i % 37, str(i % 5)) for i in range(500)], "a long, b string")
    got = T.dense_names(df.repartition(7), ["a", "b"]).collect()
    assert sorted(r.name for r in got) == list(range(len({(i % 37, i % 5) for i in range(500)})))
