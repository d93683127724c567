"""A small HTTP service around the question loop, on the standard library.

POST /api/chat answers {"question": …} at once, POST /api/chat/stream as server-sent events while the answer is made,
GET / is a page to ask from, and GET /viz/<id> shows the graph of an answer as a page.
"""

from __future__ import annotations

import html
import inspect
import json
import re
import uuid
from collections import OrderedDict
from collections.abc import Callable, Iterator
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from typing import Any

Answer = Callable[..., dict[str, Any]]
KEPT_PAGES = 200
HOME = """<!doctype html><meta charset=utf-8><title>Ask the manuals</title>
<form onsubmit="ask(event)"><input name=q size=80 placeholder="A question"><button>Ask</button></form><pre id=out></pre>
<script>async function ask(e){e.preventDefault();out.textContent='';
const r=await fetch('/api/chat/stream',{method:'POST',body:JSON.stringify({question:e.target.q.value})});
const d=new TextDecoder(),b=r.body.getReader();for(;;){const x=await b.read();if(x.done)break;out.textContent+=d.decode(x.value,{stream:true})}}</script>"""


def render(refs: list[dict[str, str]]) -> str:
    """Page of an answer's graph: its edges as a table."""
    cell = lambda r, k: f"<td>{html.escape(str(r.get(k, '')))}</td>"
    rows = "".join(f"<tr>{cell(r, 'from_entity')}{cell(r, 'relationship')}{cell(r, 'to_entity')}</tr>" for r in refs if isinstance(r, dict))
    return f"<!doctype html><meta charset=utf-8><title>Graph of the answer</title><table border=1>{rows}</table>"


def event(name: str, data: dict[str, Any]) -> str:
    return f"event: {name}\ndata: {json.dumps(data, default=str)}\n\n"


def public(result: dict[str, Any]) -> dict[str, Any]:
    return {k: v for k, v in result.items() if k != "messages"}


def told(result: dict[str, Any]) -> Iterator[str]:
    """Events of the tools of an answer that told nothing while it was made."""
    for m in result.get("messages", []):
        if m.get("role") == "tool":
            yield event("tool", {"name": m.get("name"), "content": m.get("content", "")[:400]})


def serve(answer: Answer, host: str = "127.0.0.1", port: int = 8000) -> ThreadingHTTPServer:
    """A server ready to run; the caller runs serve_forever() and shutdown(). An `answer` that takes a second argument
    gets a function to tell its steps with, which a stream passes on at once."""
    pages: OrderedDict[str, str] = OrderedDict()
    tells = len(inspect.signature(answer).parameters) > 1

    def made(question: str, tell: Callable[[dict[str, Any]], None]) -> dict[str, Any]:
        result = answer(question, tell) if tells else answer(question)
        if result.get("graph_refs"):
            name = uuid.uuid4().hex[:12]
            pages[name] = render(result["graph_refs"])
            while len(pages) > KEPT_PAGES:
                pages.popitem(last=False)
            result = {**result, "viz": f"/viz/{name}"}
        return result

    class Handler(BaseHTTPRequestHandler):
        def log_message(self, *_: Any) -> None:
            pass

        def _send(self, status: int, kind: str, body: str) -> None:
            data = body.encode()
            self.send_response(status)
            self.send_header("Content-Type", f"{kind}; charset=utf-8")
            self.send_header("Content-Length", str(len(data)))
            self.end_headers()
            self.wfile.write(data)

        def do_GET(self) -> None:  # noqa: N802
            m = re.fullmatch(r"/viz/([0-9a-z]{12})", self.path)
            if self.path == "/":
                self._send(200, "text/html", HOME)
            elif m and m[1] in pages:
                self._send(200, "text/html", pages[m[1]])
            else:
                self._send(404, "application/json", '{"error": "not found"}')

        def do_POST(self) -> None:  # noqa: N802
            if self.path not in ("/api/chat", "/api/chat/stream"):
                return self._send(404, "application/json", '{"error": "not found"}')
            try:
                question = json.loads(self.rfile.read(int(self.headers.get("Content-Length") or 0)))["question"]
                if not isinstance(question, str) or not question.strip():
                    raise ValueError
            except (ValueError, KeyError, TypeError):
                return self._send(422, "application/json", '{"error": "a question is needed"}')
            if self.path.endswith("stream"):
                return self._stream(question)
            try:
                result = made(question, lambda step: None)
            except Exception as e:  # noqa: BLE001
                return self._send(500, "application/json", json.dumps({"error": type(e).__name__}))
            return self._send(200, "application/json", json.dumps(public(result), default=str))

        def _stream(self, question: str) -> None:
            self.send_response(200)
            self.send_header("Content-Type", "text/event-stream; charset=utf-8")
            self.send_header("Connection", "close")
            self.end_headers()

            def write(text: str) -> None:
                self.wfile.write(text.encode())
                self.wfile.flush()

            try:
                result = made(question, lambda step: write(event(step.get("event", "step"), step)))
                for text in () if tells else told(result):
                    write(text)
                write(event("answer", public(result)))
            except BrokenPipeError:
                pass
            except Exception as e:  # noqa: BLE001
                write(event("error", {"error": type(e).__name__}))
            self.close_connection = True

    return ThreadingHTTPServer((host, port), Handler)
