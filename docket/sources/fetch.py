"""Fetching: pages and files over HTTP, files into the landing folder, an outside archive, texts of PDF files.

All of it runs in the executors, a row at a time; a failure is an error in its row. Tests
and offline runs pass their own functions in the place of the ones that use the network.
"""

from __future__ import annotations

import json
import re
import time
import zlib
from collections.abc import Callable, Iterator
from urllib.request import Request, urlopen

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame


def http_bytes(agent: str, timeout: float = 30.0) -> Callable[[str], bytes]:
    """Contents of an address; anything but a 2xx answer is an error. agent says who asks."""

    def get(url: str) -> bytes:
        with urlopen(Request(url, headers={"User-Agent": agent}), timeout=timeout) as answer:  # noqa: S310 - addresses are the caller's
            if not 200 <= answer.status < 300:
                raise OSError(f"{answer.status} for {url}")
            return answer.read()

    return get


def http_text(agent: str, timeout: float = 30.0) -> Callable[[str], str]:
    get = http_bytes(agent, timeout)
    return lambda url: get(url).decode("utf-8", "replace")


def http_answer(endpoint: str, agent: str, key: str = "", timeout: float = 300.0) -> Callable[[str], str]:
    """A model's answer to a prompt: the body that an endpoint returns for {"prompt", "temperature": 0}; anything but a 2xx answer is an error."""
    headers = {"User-Agent": agent, "Content-Type": "application/json"} | ({"Authorization": f"Bearer {key}"} if key else {})

    def ask(prompt: str) -> str:
        body = json.dumps({"prompt": prompt, "temperature": 0}).encode()
        with urlopen(Request(endpoint, body, headers), timeout=timeout) as answer:  # noqa: S310 - the endpoint is the caller's
            if not 200 <= answer.status < 300:
                raise OSError(f"{answer.status} for {endpoint}")
            return answer.read().decode("utf-8", "replace")

    return ask


def downloaded(files: DataFrame, fetch: Callable[[str], bytes], base_uri: str) -> DataFrame:
    """(url, relative_path, n_bytes, error) of files (url, relative_path): each is fetched and written below base_uri.

    base_uri names a folder that all executors share (file:, hdfs: or another file system that
    pyarrow opens); folders are made as needed. A file that is written again is replaced, so
    that a task can be repeated. Rows without address or path are errors; an empty table gives no rows.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, root = fs.FileSystem.from_uri(base_uri)
        for b in batches:
            sizes, errors = [], []
            for url, path in zip(b["url"], b["relative_path"], strict=True):
                try:
                    content = fetch(url)
                    system.create_dir(f"{root}/{path}".rsplit("/", 1)[0], recursive=True)
                    with system.open_output_stream(f"{root}/{path}") as out:
                        out.write(content)
                    sizes.append(len(content))
                    errors.append(None)
                except Exception as e:  # noqa: BLE001 - whatever goes wrong belongs to this row
                    sizes.append(None)
                    errors.append(f"{type(e).__name__}: {e}")
            yield pd.DataFrame({"url": b["url"], "relative_path": b["relative_path"], "n_bytes": pd.array(sizes, "Int64"), "error": errors})

    return files.select("url", "relative_path").mapInPandas(run, "url string, relative_path string, n_bytes long, error string")


def snapshots(urls: DataFrame, submit: Callable[[str], str], status: Callable[[str], str], archive_host: str, attempts: int = 10, wait: float = 3.0, sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """(pdf_url, wayback_url, error): each address is submitted, its job asked after until it is done.

    A job that is still pending after so many attempts, an error and an answer that can't be read give an error.
    """

    def one(url: str) -> tuple[str | None, str | None]:
        answer = _object(submit(url))
        job = answer.get("job_id")
        if not isinstance(job, str) or not job:
            return None, str(answer.get("message") or "not accepted")
        for k in range(attempts):
            if k:
                sleep(wait)
            said = _object(status(job))
            if said.get("status") == "success":
                at, of = said.get("timestamp"), said.get("original_url")
                return (f"{archive_host}/web/{at}/{of}", None) if isinstance(at, str) and isinstance(of, str) else (None, "success without timestamp or original_url")
            if said.get("status") != "pending":
                return None, str(said.get("message") or f"unknown status: {said.get('status')}")
        return None, f"still pending after {attempts} attempts"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = []
            for url in b["pdf_url"]:
                try:
                    got.append(one(url))
                except Exception as e:  # noqa: BLE001
                    got.append((None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame({"pdf_url": b["pdf_url"], "wayback_url": [g[0] for g in got], "error": [g[1] for g in got]})

    return urls.select("pdf_url").mapInPandas(run, "pdf_url string, wayback_url string, error string")


def _object(raw: str) -> dict:
    try:
        value = json.loads(raw)
    except ValueError:
        return {"message": "invalid JSON"}
    return value if isinstance(value, dict) else {"message": "invalid JSON"}


#: What this reader can't read: two-byte fonts and their maps, objects and references within streams, encryption.
_UNREAD = (b"/Identity-H", b"/Identity-V", b"/ToUnicode", b"/Type0", b"/ObjStm", b"/Encrypt")
_STREAM = re.compile(rb"stream\r?\n(.*?)\r?\nendstream", re.S)
_SHOWN = re.compile(rb"\((?:\\.|[^\\()])*\)|<[0-9A-Fa-f\s]*>|\bT[dDmJj*]|['\"]|\bET\b|-?\d+(?:\.\d+)?", re.S)
_ESCAPES = {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"b": b"\b", b"f": b"\f"}


def pdf_text(content: bytes) -> str:
    """The text that a PDF file's pages show, a line for each line; page breaks are line feeds like others, so that quotations go over them.

    Plain and deflated content streams in single-byte encodings. Files that would give wrong text instead (fonts with encodings of their own,
    objects within streams, encryption) are an error, as is a file that isn't a PDF: these need an extractor of the caller's.
    """
    if not content.startswith(b"%PDF"):
        raise ValueError("not a PDF file")
    if unread := [m.decode() for m in _UNREAD if m in content]:
        raise ValueError(f"a PDF file with {', '.join(unread)} needs another extractor")
    out: list[str] = []
    for m in _STREAM.finditer(content):
        data = m.group(1)
        try:
            data = zlib.decompress(data)
        except zlib.error:
            pass
        if b"BT" not in data:
            continue
        line, number = "", 0.0
        for t in _SHOWN.findall(data):
            if t[:1] in b"(<":
                line += _string(t)
            elif t in (b"Td", b"TD", b"Tm", b"T*", b"'", b'"', b"ET"):
                if line:
                    out.append(line)
                line = ""
            elif t[:1] in b"-0123456789":
                number = float(t)
                if number < -200 and line and not line.endswith(" "):  # a gap as wide as a space
                    line += " "
    return "\n".join(out)


def _string(token: bytes) -> str:
    if token[:1] == b"<":
        return bytes.fromhex(re.sub(rb"\s", b"", token[1:-1]).decode() + "0" * (len(re.sub(rb"\s", b"", token[1:-1])) % 2)).decode("cp1252", "replace")
    plain = re.sub(rb"\\([0-7]{1,3}|\r?\n|.)", lambda e: bytes([int(e[1], 8) & 255]) if e[1][:1].isdigit() and e[1][:1] < b"8" else _ESCAPES.get(e[1], b"" if e[1] in (b"\n", b"\r\n") else e[1]), token[1:-1], flags=re.S)
    return plain.decode("cp1252", "replace")
