"""Writers for synthetic feed files (CSV and minimal XLSX workbooks) used by the tests."""

import csv
import io
import os
import zipfile
from xml.sax.saxutils import escape


def write_csv(path, rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f)
        for r in rows:
            w.writerow(["" if v is None else v for v in r])


def _col(i):
    s = ""
    i += 1
    while i:
        i, r = divmod(i - 1, 26)
        s = chr(65 + r) + s
    return s


def _sheet_xml(rows):
    out = ['<?xml version="1.0" encoding="UTF-8"?>',
           '<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>']
    for r_i, row in enumerate(rows):
        cells = []
        for c_i, v in enumerate(row):
            ref = f"{_col(c_i)}{r_i + 1}"
            if v is None:
                continue
            if isinstance(v, (int, float)) and not isinstance(v, bool):
                cells.append(f'<c r="{ref}"><v>{v}</v></c>')
            else:
                cells.append(f'<c r="{ref}" t="inlineStr"><is><t>{escape(str(v))}</t></is></c>')
        out.append(f'<row r="{r_i + 1}">{"".join(cells)}</row>')
    out.append("</sheetData></worksheet>")
    return "".join(out)


def write_xlsx(path, sheets):
    """sheets: list of (name, rows)."""
    os.makedirs(os.path.dirname(path), exist_ok=True)
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("[Content_Types].xml", '<?xml version="1.0"?><Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"/>')
        sheets_xml = "".join(f'<sheet name="{escape(n)}" sheetId="{i + 1}" r:id="rId{i + 1}"/>' for i, (n, _) in enumerate(sheets))
        z.writestr("xl/workbook.xml",
                   '<?xml version="1.0"?><workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" '
                   'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships">'
                   f"<sheets>{sheets_xml}</sheets></workbook>")
        rels = "".join(f'<Relationship Id="rId{i + 1}" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/worksheet" Target="worksheets/sheet{i + 1}.xml"/>'
                       for i in range(len(sheets)))
        z.writestr("xl/_rels/workbook.xml.rels",
                   f'<?xml version="1.0"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{rels}</Relationships>')
        for i, (_, rows) in enumerate(sheets):
            z.writestr(f"xl/worksheets/sheet{i + 1}.xml", _sheet_xml(rows))
    with open(path, "wb") as f:
        f.write(buf.getvalue())


BOX_HEADER = ["GAME-ID", "PLAYER-ID", "PLAYER \nFULL NAME", "DATE", "PTS"]
ABSENCE_HEADER = ["GAME DATE", "GAME-ID", "TEAM", "OPPONENT", "PLAYER-ID", "PLAYER NAME", "STATUS", "REASON"]


def box_workbook(path, box_rows, absence_rows=None):
    sheets = [("Players", [BOX_HEADER] + box_rows)]
    if absence_rows is not None:
        sheets.append(("DNP-DND-NWT", [ABSENCE_HEADER] + absence_rows))
    write_xlsx(path, sheets)


def dfs_workbook(path, header, data_rows):
    """DFS layout: row 0 blank, row 1 header, row 2 a dummy row, data from row 3."""
    write_xlsx(path, [("DFS", [[None], header, ["dummy"] * len(header)] + data_rows)])
