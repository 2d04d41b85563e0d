"""Texts for the tests, and PDF files made with the standard library."""

import zlib

JUDGMENT = """A firm of grain dealers was refused a storage licence by the district board, and asks that the refusal be struck down.

Registered here as Civil Appeal No. 4321 of 2018, with two connected matters that abide the result.

CORAM:
HON'BLE MR. JUSTICE A.B. ANAND
HON'BLE MS. JUSTICE C. DESHMUKH

RAMESH TRADERS .... PETITIONER
against
STATE OF KERALA ..... RESPONDENTS

By an order dated 15th March 2017 the board held the firm unfit. Counsel took us first through AIR 2010 SC 1234, then (2015) 5 SCC 123.
It was said that a charge under the Indian Penal Code (IPC) had been hidden; that the Code of Criminal Procedure (CrPC) gives no power
to ask for it; and that equal treatment under the Constitution of India was denied. We find the second point good, and the others need
no answer. The board may look at the request again within three months.

In the result the appeal is allowed, each side bearing its own costs.
"""

NOISY = "REPORTABLE\nThe tenant's claim fails. Page 3 of 7\n\n   18   \nIN THE SUPREME COURT OF INDIA\nCRIMINAL APPELLATE JURISDICTION\nhttps://example.org/judgments/77\nCriminal Appeal No. 5 of 2011\nIndian Kanoon - https://indiankanoon.org/doc/990/ (copy)\nThe bail bond is cancelled."


def pdf_of(text: str, compress: bool = True) -> bytes:
    shown = b"BT /F1 12 Tf 72 720 Td 14 TL\n" + b"".join(b"(" + line.replace("\\", r"\\").replace("(", r"\(").replace(")", r"\)").encode("cp1252", "replace") + b") Tj T*\n" for line in text.split("\n")) + b"ET"
    body = zlib.compress(shown) if compress else shown
    head = b"<< /Length %d%s >>" % (len(body), b" /Filter /FlateDecode" if compress else b"")
    return b"%PDF-1.4\n1 0 obj\n<< /Type /Pages /Kids [2 0 R] >>\nendobj\n2 0 obj\n<< /Type /Page /Contents 3 0 R >>\nendobj\n3 0 obj\n" + head + b"\nstream\n" + body + b"\nendstream\nendobj\n%%EOF\n"
