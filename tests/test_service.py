from __future__ import annotations

import json
import threading
from urllib import error, request

from foliograph import service


def test_routes():
    def answer(q):
        if q == "fail":
            raise RuntimeError
        return {"answer": q.upper(), "sources": [], "graph_refs": [{"from_entity": "<a>", "relationship": "R", "to_entity": "b"}], "messages": [{"role": "tool", "name": "t", "content": "x"}]}

    server = service.serve(answer, port=0)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    base = f"http://127.0.0.1:{server.server_port}"

    def post(path, body):
        try:
            with request.urlopen(request.Request(base + path, json.dumps(body).encode())) as r:
                return r.status, r.read().decode()
        except error.HTTPError as e:
            return e.code, e.read().decode()

    try:
        status, text = post("/api/chat", {"question": "hi"})
        got = json.loads(text)
        assert status == 200 and got["answer"] == "HI" and "messages" not in got
        page = request.urlopen(base + got["viz"]).read().decode()
        assert "&lt;a&gt;" in page and request.urlopen(base + "/").status == 200
        assert [x.split("\n")[0] for x in post("/api/chat/stream", {"question": "hi"})[1].strip().split("\n\n")] == ["event: tool", "event: answer"]
        assert post("/api/chat", {})[0] == 422 and post("/api/chat", {"question": "fail"})[0] == 500 and post("/nope", {})[0] == 404
    finally:
        server.shutdown()


def test_stream_tells_steps_as_they_happen():
    gate, seen = threading.Event(), []

    def answer(q, tell):
        tell({"event": "call", "name": "expand"})
        if q == "fail":
            raise RuntimeError
        assert gate.wait(10)
        return {"answer": q}

    server = service.serve(answer, port=0)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        url = f"http://127.0.0.1:{server.server_port}/api/chat/stream"
        with request.urlopen(request.Request(url, b'{"question": "hi"}'), timeout=20) as r:
            seen.append(r.readline())  # before the answer is there
            gate.set()
            seen += [x for x in r.read().split(b"\n") if x.startswith(b"event")]
        assert seen == [b"event: call\n", b"event: answer"]
        with request.urlopen(request.Request(url, b'{"question": "fail"}'), timeout=20) as r:
            assert b"event: error" in r.read()
    finally:
        server.shutdown()
