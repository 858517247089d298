"""A local stand-in of the search service."""

import json
import threading
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from urllib.parse import parse_qs, urlsplit


class Service:
    """Answers by ``answer(operation, parameters)``: an object, or a number as HTTP status; ``asked`` keeps all requests."""

    def __init__(self, answer):
        self.asked = asked = []

        class Handler(BaseHTTPRequestHandler):
            def do_GET(self):
                params = {k: v[0] for k, v in parse_qs(urlsplit(self.path).query).items()}
                asked.append(params)
                body = answer(params.get("op"), params)
                self.send_response(body if isinstance(body, int) else 200)
                self.end_headers()
                if not isinstance(body, int):
                    self.wfile.write(json.dumps(body).encode())

            def log_message(self, *a):
                pass

        self.server = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
        self.base = f"http://127.0.0.1:{self.server.server_port}"
        threading.Thread(target=self.server.serve_forever, daemon=True).start()

    def __enter__(self):
        return self

    def __exit__(self, *a):
        self.server.shutdown()
        self.server.server_close()
