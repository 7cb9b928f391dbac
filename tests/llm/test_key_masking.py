import random
import string

from cohortloom.llm.secret_scan import MARK, secrets, without_secrets


def test_no_line_of_a_private_key_survives(spark):
    rng = random.Random(4)
    lines = ["".join(rng.choices(string.ascii_letters + string.digits + "+/", k=64)) for _ in range(24)] + ["Qm9keQ=="]
    begin, end = "-----BEGIN RSA PRIVATE KEY-----", "-----END RSA PRIVATE KEY-----"
    fields = ["Proc-Type: 4,ENCRYPTED", "DEK-Info: AES-128-CBC,0A1B2C3D", ""]
    pgp = ["-----BEGIN PGP PRIVATE KEY BLOCK-----", "Version: GnuPG v2", "", *lines, "=aB3d", "-----END PGP PRIVATE KEY BLOCK-----"]
    keys = {
        1: "\n".join([begin, *lines, end]), 2: "\r\n".join([begin, *fields, *lines, end]), 3: "\\n".join([begin, *lines, end]),
        4: " ".join([begin, *lines, end]), 5: "\n".join(pgp), 6: "\n".join([begin.replace("RSA", "ENCRYPTED"), *lines, end]),
        7: "\n".join([begin, *lines]), 8: "\n".join([begin, *fields, *lines[:-1]]), 9: "\n    ".join([begin, *lines, end]),
        10: "\\n".join([begin, *lines]), 11: "\n".join([begin] + [f'"{x}"' for x in lines] + [end])}
    texts = {i: f"Some words before.\n{key}\n\nAnd words after it stay." for i, key in keys.items()}
    texts[12] = f"{begin}\nis the header of a key. All of this stays."
    texts[13] = "\n".join([begin, *lines, "-----BEGIN CERTIFICATE-----", "public", "-----END CERTIFICATE-----"])
    docs = spark.createDataFrame([*texts.items()], "doc_id long, text string")
    got = {r.doc_id: r.text for r in without_secrets(docs).collect()}
    for i in keys:
        assert got[i] == f"Some words before.\n{MARK}\n\nAnd words after it stay.", (i, got[i])
    assert got[12] == f"{MARK}\nis the header of a key. All of this stays."
    assert got[13].startswith(MARK) and "public" in got[13] and not any(x in got[13] for x in lines)
    assert secrets(docs).where("n_assign + n_access + n_hex > 0").count() == 0
