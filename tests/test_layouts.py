"""Statements of many layouts in one batch, and records that run over lines."""

import random

from tallybook.plans.jobs import build_silver
from tallybook.schemas import ROLE_ALIASES
from tallybook.sources.inbox import file_contents, list_files, read_statements
from tallybook.sources.lake import Lake, read_silver
from tallybook.streaming.inbox_stream import ingest_files


def quoted(value, rnd):
    return '"' + value.replace('"', '\\"') + '"' if "," in value or rnd.random() < 0.3 else value


def write_layouts(folder, count, rnd):
    """Files with a header each; the rows that must come of them."""
    folder.mkdir(parents=True)
    want = []
    for k in range(count):
        sided = rnd.random() < 0.5
        roles = ["post_date", "description", *(["debit", "credit"] if sided else ["amount"]), *rnd.sample(["balance", "currency", "account_id"], rnd.randint(0, 3))]
        names = [(role, rnd.choice(ROLE_ALIASES[role])) for role in roles] + [(None, f"Extra {i}") for i in range(rnd.randint(0, 4))]
        rnd.shuffle(names)
        header = ",".join(rnd.choice([n, n.upper(), n.title()]) for _, n in names)
        lines = [header]
        for i in range(3):
            cents = rnd.randint(1, 10**6)
            values = {
                "post_date": f"2024-0{rnd.randint(1, 9)}-1{i}", "description": rnd.choice(["Shop", "Tea, green", "Bus  7", "Café"]) + f" {k}",
                "amount": f"{cents / 100:.2f}", "debit": f"{cents / 100:.2f}", "credit": "", "balance": f"{k}.5", "currency": "EUR", "account_id": f"00{k}",
            }
            lines.append(",".join(quoted(values.get(role, "x,y"), rnd) for role, _ in names))
            if rnd.random() < 0.2:
                lines.append(rnd.choice(["", "  "]))
            have = set(roles)
            want.append((
                f"{k:03d}.csv", values["post_date"], values["description"], round((-cents if sided else cents) / 100, 2),
                "EUR" if "currency" in have else None, f"00{k}" if "account_id" in have else None, k + 0.5 if "balance" in have else None,
            ))
        (folder / f"{k:03d}.csv").write_text("\n".join(lines) + "\n")
    return want


def rows(df):
    return sorted(
        ((r.source_file, r.post_date, r.description, float(r.amount), r.currency, r.account_id, None if r.balance is None else float(r.balance)) for r in df.collect()), key=repr
    )


def test_two_hundred_layouts_in_one_scan(spark, tmp_path):
    want = write_layouts(tmp_path / "in" / "ann", 200, random.Random(8))
    files = file_contents(spark, list_files(spark, f"{tmp_path}/in/ann").collect()).collect()
    read = read_statements(spark, files)
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert rows(read) == sorted(want, key=repr)


def test_records_over_lines_go_to_the_csv_reader(spark, tmp_path):
    (tmp_path / "in" / "ann").mkdir(parents=True)
    (tmp_path / "in" / "ann" / "a.csv").write_text('Date,Details,Amount\n2024-01-02,"Two\nlines, one record",-3\n2024-01-03,Plain,-4\n')
    (tmp_path / "in" / "ann" / "b.csv").write_text("Amount,Date,Details,Amount\n1,2024-01-04,Twice,2\n")
    (tmp_path / "in" / "ann" / "c.csv").write_text("Date,Details,Amount\n2024-01-05,Short\n2024-01-06,Long,5,6,7\nDate,Details,Amount\n2024-01-07,Again,8\n")
    lake = Lake(f"{tmp_path}/lake")
    files = list_files(spark, f"{tmp_path}/in/ann").collect()
    assert {f.file: f.broken_lines for f in file_contents(spark, files).collect()} == {"a.csv": True, "b.csv": False, "c.csv": False}
    assert ingest_files(spark, files, lake, "q-0") == 3
    build_silver(spark, lake)
    got = {(str(r.post_date), r.description, None if r.amount is None else float(r.amount)) for r in read_silver(spark, lake).collect()}
    assert got == {
        ("2024-01-02", "Two\nlines, one record", -3.0), ("2024-01-03", "Plain", -4.0), ("2024-01-04", "Twice", 0.0),
        ("2024-01-05", "Short", None), ("2024-01-06", "Long", 5.0), ("2024-01-07", "Again", 8.0),
    }
