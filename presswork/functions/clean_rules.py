"""Cleaning rule table (E8-E12), in execution order.

Each rule is ``(outlet, pattern, replacement)``; ``outlet`` None = all
outlets. Patterns are applied with ``regexp_replace`` (every match).
Look-arounds of the original patterns that only restate the next literal
(``x(?=y)y`` == ``xy``, ``#(?<=#)`` == ``#``) are written without them, so
the same text also runs on RE2 engines.
"""

from __future__ import annotations

# Embedded script snippet removed first (literal).
SCRIPT_NOISE = ("[\n\n\n\n\n// flash 오류를 우회하기 위한 함수 추가\n"
                "function _flash_removeCallback() {}")

# Generic rules (A3-A6), then symbols (A7-A8), then the
# unconditional outlet patterns.
GENERIC_RULES = [
    (None, r"^\[[^\]]+\]", ""),
    (None, r"^\]", ""),
    (None, r"▶.+html", ""),
    (None, r"[.].{3,6}기자", "."),
]

SYMBOLS = "━△▲▷▶[]"

UNCONDITIONAL_RULES = [
    (None, r"\[머니투데이 스타트업 미디어 플랫폼 '유니콘팩토리'\]", ""),
    (None, r"※.+", ""),
    (None, r"YTN.+입니다.", ""),
    (None, r"■ 진행 : .+인용 시 \[", ""),
    (None, r"■ 방송 : ", ""),
    (None, r". .{2,4}.?>", ""),
    (None, r". .{2,4}.?:", ""),
    (None, r"\[.{2,4}\]", ""),
    (None, r"^\(.+=뉴스1[^=]+=", ""),
    (None, r".{4}[.].{1,2}[.].{1,2}/뉴스1", ""),
    (None, r".+대표 = ", ""),
    (None, r"#.+", ""),
    (None, r".파이낸셜뉴스.+특파원.", ""),
    (None, r"\[포토\]", ""),
    (None, r"■일시:.+", ""),
]

# Outlet-conditional rules (B1-B10). The signature-tail rule
# of 한국경제 (E13) is not a pattern; it is marked by TAIL.
TAIL = "<tail after the last '. '>"

OUTLET_RULES = [
    ("매일경제", r"\[.+?기자\]", ""),
    ("매일경제", r"^\[신짜오 베트남 - .+?\]", ""),
    ("매일경제", r"\(사진\)", ""),
    ("매일경제", r"이메일 뉴스레터 매부리레터에서 더 자세한 이야기 확인할 수 있습니다. "
                r"네이버에서 매부리레터를 검색하면 됩니다.", ""),
    ("뉴시스", r"기사내용 요약.+?\[.+?=.?뉴시스\]", ""),
    ("뉴시스", r"\[.+=.?뉴시스\]", ""),
    ("뉴시스", r".{1,4} 기자.?=", ""),
    ("뉴시스", r"☞공감언론.+?com", ""),
    ("연합뉴스", r"\(.+?연합뉴스\).+?=", ""),
    ("연합뉴스", r"\[.+?제공\]", "."),
    ("연합뉴스", r"▶제보는 카톡 okjebo", ""),
    ("연합뉴스", r"[.].{3,15}@yna[.]co[.]kr", "."),
    ("연합뉴스", r"[.].?\(.+?기자\)", "."),
    ("한국경제", TAIL, ""),
    ("한국경제", r"<아파트 탐구.+\.", ""),
    ("한국경제", r"\(사진\)", ""),
    ("KBS", r"[.].{3,6}기자.?\(.{3,15}.+?@kbs[.]co[.]kr\)", "."),
    ("KBS", r"\[KBS.+?\]", ""),
    ("KBS", r"KBS 지역국", ""),
    ("중앙일보", r"[.].{3,10}기자.+joongang\.co\.kr", "."),
    ("조선일보", r"7NEWS 뉴스레터 구독하기.+?subscriptions/.{1,6}", ""),
    ("조선일보", r"기사보기", ""),
    ("조선일보", r"WEEKLY.BIZ Newsletter 구독하기.+", ""),
    ("국민일보", r"[.].{2,11}기자.+@kmib.+재배포금지", "."),
    ("아시아경제", r"\[아시아경제.+?기자\]", ""),
    ("아시아경제", r"[.].{3,10}기자.+@asiae.co.kr", "."),
    ("아시아경제", r"사진.?=.{3,6}기자", ""),
    ("아시아경제", r"[.].{3,15}@", ""),
    ("조선비즈", r"- Copyright ⓒ 조선비즈 & Chosun.com -", ""),
]

# The personnel-notice word that rejects a title (E5) and the
# wanted topic of the category gate (E4) in the original crawl.
PERSONNEL_WORD = "인사"
ECONOMY_TOPIC = "경제"

# Rules that fit the driver's pages (junk runs between words); used by the
# page job on that corpus instead of the outlet rules, which match nothing
# there.
CORPUS_RULES = [
    (None, r"%%%", ""),
    (None, r"\$\$\$", ""),
    (None, r"\*\*\*", ""),
    (None, r"###", ""),
    (None, r"&amp;&amp;&amp;", ""),
]
