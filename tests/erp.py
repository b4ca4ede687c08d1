"""A company in a few rows: tables in the ERP layout, filled row by row."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql.types import _parse_datatype_string

from stocklens.sources.tables import SCHEMAS, Tables

AS_OF = date(2025, 6, 15)
COMPANY = 1000

# document types by name
ORDER, PACKING, OTHER_TYPE = 2021, 2022, 2030
# warehouses
PAPADA, TQL_W, DSV_W, DREAM_W, HUB_W = 1000, 2040, 2050, 2060, 2070


def day(back: int) -> datetime:
    d = AS_OF - timedelta(days=back)
    return datetime(d.year, d.month, d.day, 13, 23)


class Erp:
    def __init__(self):
        self.rows: dict[str, list[dict]] = {name: [] for name in SCHEMAS}
        self._doc = 0
        for i, n in (
            (PAPADA, "Κεντρικός Παπαδά"),
            (TQL_W, "Total Quality Logistic"),
            (DSV_W, "DSV"),
            (DREAM_W, "Dream Cargo"),
            (HUB_W, "Skroutz"),
        ):
            self.add("warehouses", whouse=i, name=n, company=COMPANY)
        for i, n in (
            (ORDER, "Παραγγελία Σε Προμηθευτή"),
            (PACKING, "Packing list προμηθευτή"),
            (OTHER_TYPE, "Τιμολόγιο"),
            (2020, "Excluded"),
        ):
            self.add("doc_types", fprms=i, name=n)
        self.maker(1, "Lenovo")

    def add(self, table: str, **values) -> None:
        self.rows[table].append(values)

    def maker(self, key, name):
        self.add("makers", mtrmanfctr=key, name=name, company=COMPANY, isactive=1)

    def category(self, key, name):
        self.add(
            "categories", mtrcategory=key, name=name, company=COMPANY, isactive=1, sodtype=51
        )

    def item(self, mtrl, code, **values):
        base = dict(
            mtrl=mtrl, company=COMPANY, sodtype=51, code=code, name=f"Item {code}",
            mtrcategory=1, mtrmanfctr=1, pricer=10.0,
        )
        self.add("items", **{**base, **values})

    def partner(self, trdr, name, currency=100, kind=12):
        self.add("partners", trdr=trdr, code=f"P{trdr}", name=name, socurrency=currency, country=1)
        self.add("partner_extra", trdr=trdr, sodtype=kind)

    def document(self, source, kind, fprms, trdr, when, whouse=None, to=None, **values) -> int:
        self._doc += 1
        base = dict(
            findoc=self._doc, company=COMPANY, sosource=source, soredir=0, sodtype=kind,
            fprms=fprms, trndate=when, sotime=when, fincode=f"D{self._doc}", seriesnum=self._doc,
            sumamnt=100.0, trdr=trdr, fullytransf=0, iscancel=0, origin=0, apprv=1, period=1,
        )
        self.add("documents", **{**base, **values})
        self.add("document_stock", findoc=self._doc, whouse=whouse, whousesec=to)
        return self._doc

    def line(self, findoc, mtrl, qty, price=1.0, **values):
        base = dict(
            findoc=findoc, company=COMPANY, sodtype=51, mtrl=mtrl, qty=qty, qty1=qty,
            qty1cov=0.0, qty1canc=0.0, price=price, disc1prc=0.0,
        )
        if qty is not None and price is not None:
            base |= dict(lineval=qty * price, ltrnlineval=qty * price)
        self.add("lines", **{**base, **values})

    def purchase(self, mtrl, qty, price=1.0, whouse=PAPADA, fprms=ORDER, trdr=1, **line):
        doc = self.document(1251, 12, fprms, trdr, day(10), whouse)
        self.line(doc, mtrl, qty, price, **{"restmode": 11, **line})
        return doc

    def sale(self, mtrl, qty, back=5, fprms=7061, whouse=PAPADA, trdr=50, **line):
        doc = self.document(1351, 13, fprms, trdr, day(back), whouse)
        self.line(doc, mtrl, qty, **line)
        return doc

    def transfer(self, mtrl, qty, whouse, to, fprms=2500, state=0):
        doc = self.document(1151, 13, fprms, 50, day(3), whouse, to, fullytransf=state)
        self.line(doc, mtrl, qty)
        return doc

    def stock(self, product, source, units=0.0, customer=0.0, supplier=0.0, key=None):
        self.add(
            "stock", productid=product, supplierproductid=key or str(product), supplierid=source,
            unitsinstock=units, customerorderunits=customer, supplierorderunits=supplier,
        )

    def tables(self, spark) -> Tables:
        def frame(name):
            schema = _parse_datatype_string(SCHEMAS[name])
            rows = [tuple(r.get(f.name) for f in schema) for r in self.rows[name]]
            return spark.createDataFrame(rows, schema)

        return Tables(frame)


def rows(df, *columns):
    """Rows of some columns as sorted tuples, NULLs first."""
    got = [tuple(r) for r in df.select(*columns).collect()]
    return sorted(got, key=lambda r: tuple((v is not None, v) for v in r))
