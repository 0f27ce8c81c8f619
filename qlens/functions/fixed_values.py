"""Word lists and tables that results must agree on.

These are data, kept as plain text in their natural order, because the first
matching entry wins wherever a list is searched.
"""

# The categories a question can fall into; ids follow the list order from 1.
CATEGORY_NAMES = [
    "학교폭력",
    "교권보호 (교육활동 보호)",
    "학생 생활",
    "평가(성적) 관련",
    "전학, 편입",
    "입학 관련",
    "검정고시",
    "교원 임용고시 관련",
    "제 증명 관련",
    "정보공개",
    "기타",
]

# Word -> category, searched in order.
CATEGORY_RULES = {
    "전학": "전학, 편입",
    "편입": "전학, 편입",
    "전입": "전학, 편입",
    "성적": "평가(성적) 관련",
    "평가": "평가(성적) 관련",
    "시험": "평가(성적) 관련",
    "점수": "평가(성적) 관련",
    "입학": "입학 관련",
    "모집": "입학 관련",
    "지원": "입학 관련",
    "학교폭력": "학교폭력",
    "괴롭힘": "학교폭력",
    "왕따": "학교폭력",
    "폭행": "학교폭력",
    "교권": "교권보호 (교육활동 보호)",
    "교사": "교권보호 (교육활동 보호)",
    "선생님": "교권보호 (교육활동 보호)",
    "검정고시": "검정고시",
    "임용": "교원 임용고시 관련",
    "임용고시": "교원 임용고시 관련",
    "증명": "제 증명 관련",
    "서류": "제 증명 관련",
    "증명서": "제 증명 관련",
    "공개": "정보공개",
    "정보": "정보공개",
    "공개청구": "정보공개",
    "생활": "학생 생활",
    "학생": "학생 생활",
    "규정": "학생 생활",
    "수강신청": "학생 생활",
    "수업": "학생 생활",
    "강의": "학생 생활",
    "과제": "학생 생활",
    "숙제": "학생 생활",
    "수강": "학생 생활",
    "학점": "평가(성적) 관련",
    "성취도": "평가(성적) 관련",
    "졸업": "학생 생활",
    "휴학": "학생 생활",
    "복학": "학생 생활",
    "장학금": "학생 생활",
    "등록금": "학생 생활",
    "학비": "학생 생활",
    "기숙사": "학생 생활",
    "기계": "기타",
    "프로그램": "기타",
    "애니메이션": "기타",
    "활동": "기타",
    "조사": "기타",
    "표현": "기타",
}

# Topic words of the simple keyword, searched in order.
TOPIC_WORDS = [
    "수강신청", "전학", "편입", "성적", "평가", "시험", "입학", "졸업", "휴학", "복학",
    "장학금", "학교폭력", "교권", "검정고시", "임용", "증명서", "수업", "강의", "과제",
]

# Words that never stand for a question (keyword extraction).
KEYWORD_STOP_WORDS = [
    "을", "를", "은", "는", "이", "가", "의", "에", "에서", "로", "와", "과", "도", "만",
    "라서", "니까", "어요", "습니다", "해요", "이다", "있다", "없다",
]

# Words that never stand for a question (simple keyword).
SIMPLE_STOP_WORDS = [
    "을", "를", "은", "는", "이", "가", "의", "에", "에서", "로", "와", "과",
    "하는", "있는", "없는", "어떻게", "언제", "어디",
]

# Punctuation stripped from both ends of a keyword.
KEYWORD_PUNCTUATION = ".,!?;:\"()[]{}"

# Every Unicode blank that splits words.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Digits outside the decimal class (superscripts, circled digits and the like).
OTHER_DIGITS = (
    "²³¹፩-፱᧚⁰⁴-⁹₀-₉①-⑨⑴-⑼"
    "⒈-⒐⓪⓵-⓽⓿❶-❾➀-➈➊-➒"
    "\U00010a40-\U00010a43\U00010e60-\U00010e68\U00011052-\U0001105a\U0001f100-\U0001f10a"
)

# E-mail address pattern.
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"

# Run-log line layout and the phrases counted in it.
LOG_LINE_PATTERN = r"^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}) - (.*?) - ([A-Z]+) - ([\s\S]*)$"
LOG_FINISHED_PATTERN = "🎉.*완료"
LOG_FAILED_PATTERN = "❌.*실패"
LOG_API_OK = "API 호출 성공"
LOG_API_FAILED = "API 호출 실패"

# Report sheet and column titles.
SHEET_TITLES = {
    "main": ("채팅키워드분류", ["질문내용", "키워드", "카테고리", "질문횟수", "생성일시"]),
    "by_category": ("카테고리별통계", ["카테고리", "레코드수", "총질문횟수", "고유키워드수"]),
    "by_day": ("일별통계", ["날짜", "레코드수", "고유질문수", "총질문횟수", "고유키워드수"]),
    "top_keywords": ("상위키워드", ["키워드", "레코드수", "총질문횟수"]),
    "top_questions": ("상위질문", ["질문내용", "질문횟수", "관련키워드"]),
    "overview": ("요약정보", ["항목", "값"]),
}
OVERVIEW_ITEMS = ["조회기간", "총 레코드 수", "고유 질문 수", "고유 키워드 수", "총 질문 횟수"]
NO_DATA = "데이터 없음"
