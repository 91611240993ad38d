"""Licence notices as they stand in files."""

from __future__ import annotations

import pytest

from textloom.llm.license_scan import scan_licenses

NOTICES = [
    ("// SPDX-License-Identifier: Apache-2.0\nint x;", "apache"),
    ("# SPDX-License-Identifier: MIT\n", "mit"),
    ("/* SPDX-License-Identifier: GPL-2.0-only */", "gpl"),
    ("SPDX-License-Identifier: CC-BY-NC-SA-4.0", "cc-by-nc-sa"),
    ("SPDX-License-Identifier: CC-BY-4.0", "cc-by"),
    ("SPDX-License-Identifier: LGPL-3.0-or-later", "lgpl"),
    ("Released under the MIT licence by its authors", "mit"),
    ("Terms of service. All rights reserved.", ""),
    ("Copyright (c) 2020 Someone. All rights reserved. Redistribution and use in source and binary forms, with or without "
     "modification, are permitted provided that the following conditions are met:", "bsd"),
    ("the license identifier of this file is lost", ""),
    ("", ""),
    (None, ""),
]


@pytest.fixture(scope="module")
def found(spark):
    docs = spark.createDataFrame([(i, text) for i, (text, _) in enumerate(NOTICES)], "doc_id BIGINT, text STRING")
    return {r["doc_id"]: r for r in scan_licenses(docs).collect()}


@pytest.mark.parametrize("number", range(len(NOTICES)))
def test_notice(found, number):
    assert (found[number]["labels"] or "") == NOTICES[number][1]
