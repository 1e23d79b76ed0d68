"""Lists, lookup tables, patterns and prompt texts.

Results depend on these exact values (JSON key order, label tables, prompt
wording, leak patterns), so they are stated here once, as plain text.
"""

# --- The 11 categories, in output order -------------------------------------

CATEGORIES = (
    "address",
    "company_name",
    "email_address",
    "human_name",
    "phone_number",
    "account_identifier",
    "network_identifier",
    "system_config",
    "project_info",
    "financial_info",
    "transaction_id",
)

# The four categories that are filled with synthetic text.
SYNTHETIC_CATEGORIES = (
    "network_identifier",
    "system_config",
    "financial_info",
    "transaction_id",
)

# --- Source label -> category -----------------------------------------------

MASK_LABELS = {
    "GIVENNAME": "human_name",
    "SURNAME": "human_name",
    "CITY": "address",
    "STREETBUILDINGNUM": "address",
    "ZIPCODE": "address",
    "EMAIL": "email_address",
    "TELEPHONENUM": "phone_number",
    "TITLE": "company_name",
    "USERNAME": "account_identifier",
    "IDCARDNUM": "account_identifier",
    "DRIVERLICENSENUM": "account_identifier",
    "SOCIALNUM": "account_identifier",
    "CREDITCARDNUMBER": "financial_info",
    "TAXNUM": "financial_info",
}

ENTITY_TYPES = {
    "人名": "human_name",
    "法人名": "company_name",
    "政治的組織名": "company_name",
    "その他の組織名": "company_name",
    "地名": "address",
    "施設名": "address",
    "製品名": "project_info",
}

# --- Chat roles and template markers ----------------------------------------

SHAREGPT_ROLES = {"human": "user", "gpt": "assistant", "system": "system"}

TEMPLATE_MARKERS = {
    "turn_start": "<|im_start|>",
    "turn_end": "<|im_end|>",
    "tool_list_start": "<|tool_list_start|>",
    "tool_list_end": "<|tool_list_end|>",
    "tool_response_start": "<|tool_response_start|>",
    "tool_response_end": "<|tool_response_end|>",
}

# --- Text delimiters used when rows are concatenated ------------------------

MIX_DELIMITERS = ("。", "\n")

# --- Prompt texts -----------------------------------------------------------

EXTRACTION_PROMPT = (
    "あなたはテキストから社外秘の固有表現を抽出するアシスタントです。"
    "入力テキストを分析し、以下の11カテゴリの機密情報を抽出して、必ずJSON形式のみで出力してください。\n\n"
    "カテゴリ定義:\n"
    "- address: 住所・所在地\n"
    "- company_name: 企業・研究機関・組織名\n"
    "- email_address: メールアドレス\n"
    "- human_name: 人名\n"
    "- phone_number: 電話番号\n"
    "- account_identifier: アカウント識別子（ユーザーID・アカウント名・従業員番号・社会保障番号・マイナンバー等）\n"
    "- network_identifier: ネットワーク識別情報（IPアドレス・MACアドレス・内部ドメイン・ホスト名）\n"
    "- system_config: システム構成情報（ファイルパス・ディレクトリ構造・DBテーブル/カラム名）\n"
    "- project_info: プロジェクト関連情報（プロジェクト名・開発コードネーム・未発表の製品/機能名）\n"
    "- financial_info: 金額・財務情報（売上・原価・利益率・契約金額・個人の給与/報酬額）\n"
    "- transaction_id: 取引管理番号（契約書番号・請求書番号・見積書番号・顧客管理ID）\n\n"
    "出力形式（全キーを必ず含め、該当なしは空リスト）:\n"
    '{"address": [], "company_name": [], "email_address": [], "human_name": [], '
    '"phone_number": [], "account_identifier": [], "network_identifier": [], '
    '"system_config": [], "project_info": [], "financial_info": [], "transaction_id": []}'
)

WRITER_PROMPT = (
    "あなたは日本語のビジネス文書を作成するプロのライターです。"
    "与えられた条件に従って、その場面で実際にやり取りされそうな自然で具体的な日本語の文章を1つだけ作成します。"
    "出力は文章の本文のみとし、JSON・コードブロック・前置き・後書き・"
    "「以下が例文です」等の説明・本文を囲う引用符は一切付けないでください。"
)

POSITIVE_PROMPT = """\
「{situation}」という場面で実際にやり取りされそうな、自然な日本語の文章を1〜3文で作成してください。

次の文字列を、表記を一切変えず**一字一句そのまま**本文中に含めてください（{description}）:
{bullets}

注意:
- 上記の文字列以外には、機密情報（人名・メールアドレス・電話番号・住所・実在する企業名・上記以外の識別番号や金額など）を一切含めないでください。
- 日本語で、その場面にふさわしい自然な文体にしてください。
- 本文のみを出力してください（説明・引用符・JSONは不要）。"""

NEGATIVE_PROMPT = """\
「{situation}」という場面で実際にやり取りされそうな、自然な日本語の文章を1〜3文で作成してください。

この文章は「{description}」に関する話題に触れても構いませんが、**具体的な値は一切書かない**ハードネガティブな例文にしてください。
（例:「IPアドレスは確認済みです」「請求書を送付しました」のように、話題には言及しても具体的な番号・パス・金額・アドレス等は書かない）

参考: この文章に**書いてはいけない**具体値の形式例:
{bullets}

注意:
- 人名・メールアドレス・電話番号・住所・企業名・金額・各種識別番号・IPアドレス・ファイルパス等、いかなる機密情報も含めないでください。
- 本文のみを出力してください（説明・引用符・JSONは不要）。"""

POOL_SYSTEM_PROMPT = (
    "あなたはITセキュリティ・個人情報保護のテストデータ専門家です。"
    "指定された種類の値を、多様かつ現実的に生成します。"
    "1行に1値を出力し、値のみを書いてください（番号・記号・引用符・説明は不要）。"
    "日本の企業・ITシステムで実際に使われそうな値にしてください。"
)

POOL_PROMPT = """\
次の種類の値を {count} 個、なるべく多様に生成してください。

種類: {description}

参考例（これらとは異なる新しい値を生成してください）:
{bullets}

1行に1値、値のみを出力してください。"""

POOLED_SUBTYPES = (
    "internal_api_endpoint",
    "cron_batch_schedule",
    "error_log_stacktrace",
    "config_key_value",
    "file_path_windows",
    "db_column",
    "env_variable",
    "vpn_wifi_config",
)

VOICE_PROMPT = "Perform TTS. Use the Irish female voice."

# --- Leak patterns, one per synthetic category ------------------------------

LEAK_PATTERNS = {
    "network_identifier": (
        r"(?:\d{1,3}\.){3}\d{1,3}"
        r"|[0-9A-Fa-f]{2}(?::[0-9A-Fa-f]{2}){5}"
        r"|[0-9A-Fa-f]{2}(?:-[0-9A-Fa-f]{2}){5}"
        r"|[\w-]\.(?:local|internal|intranet)\b"
        r"|https?://\S|\\\\\S|smb://\S"
    ),
    "system_config": (
        r"/(?:var|etc|opt|home|srv|usr)/"
        r"|[A-Za-z]:\\"
        r"|\.(?:log|ya?ml|conf|json|java|py|ini)\b"
        r"|\w\.\w+\b(?=\s*(?:カラム|テーブル))"
        r"|\*/?\d+\s+\*\s+\*\s+\*"
    ),
    "financial_info": r"[¥$]\s?\d|\d[\d,]*\s*(?:円|万円|億)|\d+(?:\.\d+)?\s*%",
    "transaction_id": r"[A-Z]{2,}[-_]?\d{2,}|#\d{3,}|\b\d{3,}-\d{2,}",
}
