"""A thin HTTP face over ``run.response``: posts as JSON, a health route and static files."""

from __future__ import annotations

import json
import posixpath
from collections.abc import Callable
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from pathlib import Path
from urllib.parse import parse_qs, unquote, urlsplit

# Content types by file ending.
TYPES = {".html": "text/html; charset=utf-8", ".js": "text/javascript; charset=utf-8", ".css": "text/css; charset=utf-8", ".json": "application/json; charset=utf-8", ".svg": "image/svg+xml", ".png": "image/png", ".ico": "image/x-icon"}
JSON = {"Content-Type": TYPES[".json"], "Cache-Control": "no-store"}
Reply = tuple[int, dict[str, str], bytes]


def static_file(root: Path, path: str) -> Reply:
    """A file below ``root`` (a folder's index.html), else 404; paths never lead out of it."""
    inner = posixpath.normpath("/" + unquote(path)).lstrip("/")
    file = root / inner
    file = file / "index.html" if file.is_dir() else file
    if not (file.is_file() and file.resolve().is_relative_to(root.resolve())):
        return 404, {"Content-Type": "text/plain; charset=utf-8"}, b"404 Not Found"
    end = file.suffix.lower()
    return 200, {"Content-Type": TYPES.get(end, "application/octet-stream"), "Cache-Control": "no-cache" if end == ".html" else "public, max-age=3600"}, file.read_bytes()


def route(target: str, respond: Callable[[bool], str], root: Path | None = None) -> Reply:
    """The reply to one request target; ``respond`` gives the JSON text of a collection (True: the sample is forced)."""
    url = urlsplit(target)
    if url.path == "/api/posts":
        try:
            return 200, JSON, respond(parse_qs(url.query).get("sample", [""])[0] == "1").encode()
        except Exception as e:  # the client gets the reason
            return 500, JSON, json.dumps({"error": str(e)}, ensure_ascii=False).encode()
    if url.path == "/api/health":
        return 200, JSON, b'{"ok":true}'
    return static_file(root, url.path) if root else (404, {"Content-Type": "text/plain; charset=utf-8"}, b"404 Not Found")


def server(respond: Callable[[bool], str], root: Path | None = None, port: int = 3000, host: str = "127.0.0.1") -> ThreadingHTTPServer:
    """A server to be started with ``serve_forever``."""

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self) -> None:
            status, headers, body = route(self.path, respond, root)
            self.send_response(status)
            for k, v in {**headers, "Content-Length": str(len(body))}.items():
                self.send_header(k, v)
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *args: object) -> None:
            pass

    return ThreadingHTTPServer((host, port), Handler)


def main() -> None:
    from functools import partial

    from pyspark.sql import SparkSession

    from .config import Config
    from .run import response

    spark = SparkSession.builder.appName("postatlas").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    config = Config.from_env()
    server(lambda sample: partial(response, spark, config)(force_sample=sample), Path("public"), config.port, "0.0.0.0").serve_forever()


if __name__ == "__main__":
    main()
