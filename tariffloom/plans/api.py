"""The conversion jobs over HTTP: convert (202, 400), status (404) and health. Standard library only."""

from __future__ import annotations

import json
from dataclasses import asdict, fields
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

from tariffloom.plans.jobs import ConvertRequest, Jobs

BASE = "/api/v1"


def handler(jobs: Jobs, check=lambda: {}):
    """A request handler on some jobs. check: gives further facts of the service's health, or raises."""

    class Handler(BaseHTTPRequestHandler):
        def _answer(self, code: int, body: dict) -> None:
            data = json.dumps(body, default=str).encode()
            self.send_response(code)
            self.send_header("Content-Type", "application/json")
            self.send_header("Content-Length", str(len(data)))
            self.end_headers()
            self.wfile.write(data)

        def do_POST(self) -> None:
            if self.path.rstrip("/") != f"{BASE}/convert":
                return self._answer(404, {"detail": "no such path"})
            try:
                body = json.loads(self.rfile.read(int(self.headers.get("Content-Length") or 0)) or b"{}")
                known = {f.name for f in fields(ConvertRequest)}
                request = ConvertRequest(**{k: v for k, v in body.items() if k in known})
            except (ValueError, TypeError, AttributeError) as e:
                return self._answer(400, {"detail": str(e)})
            return self._answer(202, {"job_id": (job := jobs.submit(request)), "status": "pending", "status_url": f"{BASE}/status/{job}"})

        def do_GET(self) -> None:
            path = self.path.rstrip("/")
            if path == f"{BASE}/health":
                try:
                    return self._answer(200, {"status": "healthy", **check()})
                except Exception as e:  # whatever is wrong is the answer
                    return self._answer(503, {"status": "unhealthy", "detail": str(e)})
            if path.startswith(f"{BASE}/status/"):
                try:
                    job = jobs.status(path.rsplit("/", 1)[1])
                except KeyError:
                    return self._answer(404, {"detail": "no such job"})
                return self._answer(200, {"job_id": job.id, "status": str(job.status), "progress": job.progress, "result": job.result, "error": job.error, "created_at": job.created_at, "request": asdict(job.request)})
            return self._answer(404, {"detail": "no such path"})

        def log_message(self, *args) -> None:
            """Requests are not logged: they name providers."""

    return Handler


def serve(jobs: Jobs, host: str = "127.0.0.1", port: int = 8000, check=lambda: {}) -> ThreadingHTTPServer:
    """A server that the caller runs (serve_forever) and shuts down."""
    return ThreadingHTTPServer((host, port), handler(jobs, check))
