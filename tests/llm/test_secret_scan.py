"""Private keys with header lines and PGP blocks."""

import pytest

from tallyspark.llm import secret_scan

BODY = "MIIEow+/abc=\n" * 3


@pytest.mark.parametrize("label, head", [
    ("RSA PRIVATE KEY", "Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,0123ABCD\n\n"),
    ("RSA PRIVATE KEY", "Proc-Type: 4,ENCRYPTED\r\nDEK-Info: AES-128-CBC,0123ABCD\r\n\r\n"),
    ("PGP PRIVATE KEY BLOCK", "Version: GnuPG v2\nComment: a b, c\n\n"), ("PGP PRIVATE KEY BLOCK", "\n"), ("PRIVATE KEY", "")])
def test_private_keys(spark, label, head):
    key = f"-----BEGIN {label}-----\n{head}{BODY}-----END {label}-----"
    rows = spark.createDataFrame([(f"a {key} b {key}",), (key.replace("END ", "END X"),)], "text string")
    spans, other = [[tuple(s) for s in r.spans] for r in secret_scan.scan(rows).collect()]
    assert spans == [("pem", 2, 2 + len(key)), ("pem", 5 + len(key), 5 + 2 * len(key))] and not other
    assert secret_scan.redact(rows.limit(1)).first().text == "a [SECRET] b [SECRET]"
