"""The repair by a table of (cost, audit) over nodes, relaxed to a fixed point, and small cases by hand."""

import hashlib
import random
import re
import zlib

import pytest

from tidemill.llm import chat_repair as R

WS=" \t\n\x0b\x0c\r"
def key(r,x): return hashlib.sha256((str(len(r.encode()))+":"+r+x).encode()).digest()
def brute(rows):
    convs={}
    sp=lambda v:" " if v is None else str(v)
    for c,t,r,x in rows:
        L=convs.setdefault(c,[])
        k=zlib.crc32(f"{sp(c)}:{sp(t)}".encode())%20
        r=" " if r is None else r; x=" " if x is None else x
        if k==0: continue
        if k==1: x=""
        if k==2: x=re.sub("[.!?]","",x)
        if k==4: r="user"
        L.append((t,r,x))
        if k==3: L.append((t,r,x))
    out=[]
    for c,L in convs.items():
        L=sorted(L,key=lambda v:(v[0] is not None,v[0] or 0,key(v[1],v[2])))
        seen=set(); fl=[]
        for t,r,x in L:
            s=x.strip(WS)
            if not s: f="b"
            elif (r,x) in seen: f="d"
            elif s[-1] not in ".!?": f="t"
            else: f=""
            seen.add((r,x)); fl.append(f)
        turns=[t for t,_,_ in L if t is not None]
        gaps=max(turns)-min(turns)+1-len(set(turns)) if turns else 0
        ini=[r[:1] for _,r,_ in L]
        ill=sum(a+b not in("su","ua","au") for a,b in zip(ini,ini[1:]))
        # DP over (i,g) from the end with relaxations: value=(cost,audit), iterate to a fixed point
        n=len(L); D={0:{'s':1,'u':2},1:{'u':2},2:{'a':3},3:{'u':2}}
        best=[[None]*4 for _ in range(n+1)]
        for i in range(n,-1,-1):
            for _ in range(6):
                for g in range(4):
                    cand=[]
                    if i==n and g in(0,3): cand.append((0,""))
                    for ch,role in(("u","user"),("a","assistant")):
                        if ch in D[g]:
                            b=best[i][D[g][ch]]
                            if b: cand.append((b[0]+5,"I"+b[1]))
                    if i<n:
                        b=best[i+1][g]
                        if b: cand.append((b[0]+2,"D"+b[1]))
                        if fl[i] not in("b","d"):
                            e=5 if fl[i]=="t" else 0
                            if ini[i] in D[g]:
                                b=best[i+1][D[g][ini[i]]]
                                if b: cand.append((b[0]+e,"K"+b[1]))
                            for ch in "ua":
                                if ch in D[g]:
                                    b=best[i+1][D[g][ch]]
                                    if b: cand.append((b[0]+1+e,"R"+b[1]))
                    if cand: best[i][g]=min(cand)
        cost,audit=best[0][0]
        g=0;i=0;lines=[]
        for a in audit:
            if a=="D": i+=1; continue
            if a=="K": role,text=L[i][1],L[i][2]; i+=1; g=D[g][role[:1]]
            else:
                ch="a" if g==2 else "u"; role={"u":"user","a":"assistant"}[ch]; g=D[g][ch]
                text=""
                if a=="R": text=L[i][2]; i+=1
            lines.append(role+":"+text)
        out.append((c,gaps,fl.count("b"),fl.count("d"),fl.count("t"),ill,cost,audit,hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out,key=str)


def same(df):
    got = sorted(map(tuple, R.repair(df).collect()), key=str)
    assert got == brute([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])
    return got


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_the_test_tables(spark, sf):
    df = R.op11_chat_repair(spark, f"/root/testdata/{sf}")
    source = spark.read.parquet(f"/root/testdata/{sf}/conversations.parquet")
    assert sorted(map(tuple, df.collect()), key=str) == brute([tuple(r) for r in source.select("conv_id", "turn", "role", "text").collect()])


def test_a_hot_conversation_nulls_ties_and_clashing_names(spark):
    rng = random.Random(3)
    roles, texts = ["user", "assistant", "system", None, "", "tool", "u", "User"], ["a.", "b!", "c", "", "  ", None, "x?", "d. ", "e.\n", "y"]
    rows = []
    for _ in range(1200):
        conv = None if rng.random() < 0.1 else rng.randrange(40) if rng.random() < 0.6 else 7
        text = rng.choice(["q", "r", ""]) + (rng.choice(texts) or "") if rng.random() < 0.9 else None
        rows.append((conv, None if rng.random() < 0.1 else rng.randrange(-3, 30), rng.choice(roles[:3]) if rng.random() < 0.8 else rng.choice(roles), text, 1, "x"))
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, part int, conv string")
    assert R.spread(R.with_faults(R.ranged(R.damaged(df)))).count() > 1  # some conversations lie in several ranges
    same(df)


def test_empty_and_all_dropped(spark):
    kind = "conv_id long, turn long, role string, text string"
    assert R.repair(spark.createDataFrame([], kind)).collect() == []
    turn = next(t for t in range(1000) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    (row,) = same(spark.createDataFrame([(5, turn, "user", "hello.")], kind))
    assert row[1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_distances_and_walks_of_split_rows():
    """Blocks folded over their borders give the audit of the whole."""
    rng = random.Random(4)
    for _ in range(300):
        rows = [R.Row(rng.choice("suax"), rng.random() < 0.2, rng.random() < 0.3) for _ in range(rng.randrange(1, 12))]
        found = R.distances(rows)
        _, whole = R.walk(rows, found, 0, True)
        cut = rng.randrange(len(rows) + 1)
        left, right = rows[:cut], rows[cut:]
        far = R.distances(right)
        near = R.distances(left, tuple(far[0]))
        assert near[0][0] == found[0][0]
        g, first = R.walk(left, near, 0, False)
        assert first + R.walk(right, far, g, True)[1] == whole
