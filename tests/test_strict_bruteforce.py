"""D10 against a brute-force reading of the decision table
on random scenarios, batched: paths and contents carry the scenario id, so
scenarios never interact."""

import datetime as dt
import hashlib
import random

from pagewright.operators import changes as D

REG = "doc_id string, path string, content_hash string, status string, created_at timestamp_ntz, updated_at timestamp_ntz"


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def scenario(rnd, k):
    paths = [f"s{k}/p{i}.pdf" for i in range(rnd.randint(1, 7))]
    contents = [f"s{k}-c{i}" for i in range(rnd.randint(1, 4))]
    reg, scan, errors = [], {}, set()
    for p in paths:
        for v in range(rnd.choice([0, 1, 1, 2])):          # versions of this path in the registry
            c = rnd.choice(contents)
            status = rnd.choice(["ACTIVE", "ACTIVE", "INACTIVE"])
            h = "" if rnd.random() < 0.15 else sha(c)
            reg.append((sha(c + p), p, h, status, dt.datetime(2024, 1, 1 + v), dt.datetime(2024, 1, 1)))
    for p in paths:
        r = rnd.random()
        if r < 0.6:
            scan[p] = rnd.choice(contents)
        elif r < 0.7:
            errors.add(p)
    # dedupe registry doc ids (primary key)
    seen, uniq = set(), []
    for row in reg:
        if row[0] not in seen:
            seen.add(row[0])
            uniq.append(row)
    return uniq, scan, errors


def brute(reg, scan, errors):
    active = {}
    for d, p, h, st, ca, _ in reg:
        if st == "ACTIVE" and (p not in active or (ca, d) > (active[p][2], active[p][0])):
            active[p] = (d, h or "", ca)
    inactive = {d for d, p, h, st, ca, _ in reg if st == "INACTIVE"}
    held = {v[1] for v in active.values() if v[1]}
    scan_hashes = {sha(c) for c in scan.values()}
    out, cands = set(), {}
    for p, c in scan.items():
        h, d = sha(c), sha(c + p)
        if p in active:
            out.add(("UNCHANGED" if active[p][1] in (h, "") else "MODIFIED", p, None))
        elif d in inactive:
            out.add(("RESURRECTED", p, None))
        elif h in held:
            cands.setdefault(h, []).append(p)
        else:
            out.add(("NEW", p, None))
    vac = {}
    for p, (d, h, _) in active.items():
        if h and not (p in scan and sha(scan[p]) == h) and p not in errors:
            vac.setdefault(h, []).append(p)
    sources = set()
    for h, cs in cands.items():
        vs = sorted(vac.get(h, []))
        for i, p in enumerate(sorted(cs)):
            if i < len(vs):
                out.add(("MOVED", p, vs[i]))
                sources.add(vs[i])
            else:
                out.add(("COPIED", p, None))
    for p, (d, h, _) in active.items():
        if p in scan:
            continue
        if p in errors:
            out.add(("ERROR", p, None))
        elif p in sources:
            continue
        elif h and h in scan_hashes:
            out.add(("ORPHANED", p, None))
        else:
            out.add(("DELETED", p, None))
    return out


def test_strict_classes_match_brute_force(spark):
    rnd = random.Random(11)
    regs, scans, errs, want = [], [], [], set()
    for k in range(60):
        reg, scan, errors = scenario(rnd, k)
        regs += reg
        scans += [(p, sha(c), sha(c + p)) for p, c in scan.items()]
        errs += [(p, "unreadable") for p in errors]
        want |= brute(reg, scan, errors)
    reg_df = spark.createDataFrame(regs, REG)
    scan_df = spark.createDataFrame(scans, "path string, content_hash string, doc_id string")
    err_df = spark.createDataFrame(errs, "path string, error string")
    got = {(r.change, r.path, r.old_path)
           for r in D.detect_changes_strict(scan_df, reg_df, err_df).collect()}
    assert got == want
    assert {c for c, _, _ in want} == {"UNCHANGED", "MODIFIED", "RESURRECTED", "MOVED", "COPIED", "NEW",
                                       "ERROR", "ORPHANED", "DELETED"}
