"""Liveness, startup and readiness probes over HTTP."""

from __future__ import annotations

import threading
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

PATHS = {"/health/live": "live", "/health/startup": "started", "/health/ready": "ready"}


class Probes:
    """live is true from the start; started and ready are set by the engine."""

    def __init__(self):
        self.live, self.started, self.ready = True, False, False

    def answer(self, path: str) -> int:
        name = PATHS.get(path.partition("?")[0].rstrip("/"))
        return 404 if name is None else 200 if getattr(self, name) else 503

    def serve(self, port: int = 8080) -> ThreadingHTTPServer:
        probes = self

        class Handler(BaseHTTPRequestHandler):
            def do_GET(self):
                self.send_response(probes.answer(self.path))
                self.end_headers()

            def log_message(self, *_):
                pass

        server = ThreadingHTTPServer(("0.0.0.0", port), Handler)
        threading.Thread(target=server.serve_forever, daemon=True).start()
        return server
