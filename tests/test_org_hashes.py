"""J12: lookup file loading with a fixed schema and the quality report."""

import os
import tempfile

from shelfspark.operators.org_hashes import org_hash_quality
from shelfspark.sources.org_hashes import load_org_hashes

TOKEN_A = "A" * 20 + "b1"          # 22-character tokens (made up)
TOKEN_B = "B" * 20 + "c2"


def test_load_and_report(spark):
    root = tempfile.mkdtemp(prefix="hashes-", dir=os.environ.get("TMPDIR", "/tmp"))
    path = f"{root}/hashes.csv"
    with open(path, "w") as f:
        f.write("organisation_id,hash\n")
        f.write(f"1,{TOKEN_A}==\n")                      # plain
        f.write(f"1,{TOKEN_A}==regcode=12AB34\n")         # regcode
        f.write(f"1,{TOKEN_A}==regcode=8.12E+37\n")       # mangled by a spreadsheet
        f.write(f"2,{TOKEN_B}==\n")
        f.write(f"2,{TOKEN_B}==\n")                      # duplicate plain hash
        f.write(f"3,{TOKEN_A}==regcode=99ZZ\n")           # token of organisation 1
        f.write(f"4,  {TOKEN_B}&utm_source=x \n")         # other (and padded)
    hashes = load_org_hashes(spark, path)
    assert [f.name for f in hashes.schema.fields] == ["organisation_id", "hash"]
    rep = {r["organisation_id"]: r.asDict() for r in org_hash_quality(hashes).collect()}
    assert (rep[1]["n_plain"], rep[1]["n_regcode"], rep[1]["n_mangled"]) == (1, 1, 1)
    assert rep[2]["n_hashes"] == 2 and rep[2]["n_distinct_hashes"] == 1 and rep[2]["n_plain"] == 2
    assert rep[1]["n_shared_tokens"] == 1 and rep[3]["n_shared_tokens"] == 1
    assert rep[4]["n_other"] == 1 and rep[4]["n_shared_tokens"] == 1   # shares TOKEN_B with 2
    assert rep[2]["n_shared_tokens"] == 1


def test_read_domain_with_fixed_schema(spark):
    from shelfspark.sources.adapters import Tables
    from shelfspark.sources.tables import read_domain
    root = tempfile.mkdtemp(prefix="domain-", dir=os.environ.get("TMPDIR", "/tmp"))
    t = Tables(spark, "/root/testdata/sf0.001")
    t.subscriptions.write.parquet(f"{root}/subscriptions")
    back = read_domain(spark, "subscriptions", f"{root}/subscriptions")
    assert back.schema.simpleString() == t.subscriptions.schema.simpleString()
    assert back.count() == t.subscriptions.count()
