"""Shareholding filings: counts by category out of XBRL facts, and the choice among revised filings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.core import latest
from tidemark.sources.filings import parse_facts

#: Member names of the categories and the columns that hold their shares.
MEMBERS = {
    "ShareholdingOfPromoterAndPromoterGroupMember": "promoter_shares",
    "SharesHeldByNonPromoterNonPublicShareholdersMember": "non_promoter_non_public_shares",
    "MutualFundsOrUTIMember": "mutual_funds_shares",
    "VentureCapitalFundsMember": "venture_capital_funds_shares",
    "AlternativeInvestmentFundsMember": "alternative_investment_funds_shares",
    "BanksMember": "banks_shares",
    "InsuranceCompaniesMember": "insurance_companies_shares",
    "ProvidentFundsOrPensionFundsMember": "provident_pension_funds_shares",
    "AssetReconstructionCompaniesMember": "asset_reconstruction_companies_shares",
    "SovereignWealthFundsDomesticMember": "domestic_sovereign_wealth_funds_shares",
    "NBFCsRegisteredWithRBIMember": "nbfc_shares",
    "OtherFinancialInstitutionsMember": "other_domestic_financial_institutions_shares",
    "InstitutionsDomesticMember": "domestic_institutions_shares",
    "ForeignDirectInvestmentMember": "fdi_shares",
    "ForeignVentureCapitalInvestorsMember": "foreign_vc_investors_shares",
    "SovereignWealthFundsForeignMember": "foreign_sovereign_wealth_funds_shares",
    "InstitutionsForeignPortfolioInvestorCategoryOneMember": "fpi_category_i_shares",
    "InstitutionsForeignPortfolioInvestorCategoryTwoMember": "fpi_category_ii_shares",
    "OverseasDepositoriesMember": "overseas_depositories_shares",
    "OtherInstitutionsForeignMember": "other_foreign_institutions_shares",
    "InstitutionsForeignMember": "foreign_institutions_shares",
    "CentralGovernmentOrPresidentOfIndiaMember": "government_shares",
    "StateGovernmentsOrGovernorsMember": "government_state_shares",
    "ShareholdingByCompaniesOrBodiesCorporateWhereCentralOrStateGovernmentIsPromoterMember": "government_promoted_companies_shares",
    "GovernmentsMember": "governments_shares",
    "AssociateCompaniesOrSubsidiariesMember": "associate_companies_subsidiaries_shares",
    "DirectorsAndDirectorsRelativesMember": "directors_relatives_shares",
    "KeyManagerialPersonnelMember": "key_managerial_personnel_shares",
    "RelativesOfPromotersOtherThanPromoterGroupMember": "promoter_relatives_shares",
    "TrustsWhereAnyPersonBelongingToPromoterAndPromoterGroupIsTrusteeOrBeneficiaryOrAuthorOfTrustMember": "promoter_related_trusts_shares",
    "InvestorEducationAndProtectionFundMember": "iepf_shares",
    "ResidentIndividualShareholdersHoldingNominalShareCapitalUpToRsTwoLakhMember": "resident_individuals_upto_2l_shares",
    "ResidentIndividualShareholdersHoldingNominalShareCapitalInExcessOfRsTwoLakhMember": "resident_individuals_above_2l_shares",
    "NonResidentIndiansMember": "nris_shares",
    "ForeignNationalsMember": "foreign_nationals_shares",
    "ForeignCompaniesMember": "foreign_companies_shares",
    "BodiesCorporateMember": "bodies_corporate_shares",
    "OtherNonInstitutionsMember": "other_non_institutions_shares",
    "NonInstitutionsMember": "non_institutions_shares",
    "PublicShareholdingMember": "public_shares",
    "ShareholdingPatternMember": "shareholding_pattern_shares",
}
AXIS = "CategoryOfShareholdersAxis"
#: Members that make up the whole, and the context that states it.
PROMOTER = ("ShareholdingOfPromoterAndPromoterGroupMember", "PromoterAndPromoterGroupMember", "PromoterMember")
PUBLIC = ("PublicShareholdingMember", "PublicMember")
NEITHER = ("SharesHeldByNonPromoterNonPublicShareholdersMember", "NonPromoterNonPublicShareholdersMember")
WHOLE_CONTEXT = "ShareholdingPattern_ContextI"


def share_facts(facts: DataFrame) -> DataFrame:
    """NumberOfShares facts that are whole, non-negative numbers."""
    rows = facts.where("error IS NULL AND concept = 'NumberOfShares'").withColumn("shares", F.floor(F.col("value").try_cast("double")).cast("long"))
    return rows.where("shares >= 0")


def _max_of(members: tuple[str, ...]) -> Column:
    return F.max(F.when(F.arrays_overlap("members", F.array(*map(F.lit, members))), F.col("shares")))


def snapshots(facts: DataFrame) -> DataFrame:
    """One row per filing: total_shares and the shares of each category.

    A category's facts lie in contexts on the category axis; the last in the document counts, and the sum of all
    governments stands for the government if it is given. The total is, in this order: promoters + public + neither if at
    least two of them are given; the whole's own context; the whole's member; the largest count without members; promoters
    + public.
    """
    rows = share_facts(facts)
    on_axis = F.array_contains("members", AXIS)
    last = [F.max_by(F.when(on_axis & F.array_contains("members", m), F.col("shares")), F.when(on_axis & F.array_contains("members", m), F.col("pos"))).alias(c) for m, c in MEMBERS.items()]
    first = lambda cond: F.min_by(F.when(cond, F.col("shares")), F.when(cond, F.col("pos")))
    out = rows.groupBy("filing_id", "company_id", "period_end").agg(
        *last,
        _max_of(PROMOTER).alias("_promoter"), _max_of(PUBLIC).alias("_public"), _max_of(NEITHER).alias("_neither"),
        first(F.col("context") == WHOLE_CONTEXT).alias("_context"),
        first(F.array_contains("members", "ShareholdingPatternMember")).alias("_member"),
        F.max(F.when(F.size("members") == 0, F.col("shares"))).alias("_bare"),
    )
    parts = ("_promoter", "_public", "_neither")
    given = reduce(lambda a, b: a + b, [F.col(c).isNotNull().cast("int") for c in parts])
    total = reduce(lambda a, b: a + b, [F.coalesce(F.col(c), F.lit(0)) for c in parts])
    whole = F.coalesce(F.when((given >= 2) & (total > 0), total), "_context", "_member", "_bare", F.col("_promoter") + F.col("_public"))
    return out.withColumn("government_shares", F.coalesce("governments_shares", "government_shares")).select("filing_id", "company_id", "period_end", whole.alias("total_shares"), *MEMBERS.values())


def total_by_pattern(content: Column) -> Column:
    """For documents that don't parse: the largest number between NumberOfShares tags."""
    found = F.regexp_extract_all(content, F.lit(r"(?i)<[^>]*NumberOfShares(?:\s[^>]*)?>\s*([0-9]+(?:\.[0-9]+)?)\s*</[^>]*NumberOfShares>"), F.lit(1))
    return F.array_max(F.transform(found, lambda x: x.try_cast("double").cast("long")))


def extract(documents: DataFrame) -> DataFrame:
    """snapshots() of documents (filing_id, company_id, period_end, content), with error.

    A document that can't be parsed has a row all the same: its total by pattern, null without a count, no categories, and
    in error why.
    """
    facts = parse_facts(documents)
    whole = snapshots(facts).withColumn("error", F.lit(None).cast("string"))
    broken = facts.where("error IS NOT NULL").select("filing_id", "error")
    found = documents.join(broken, "filing_id").select("filing_id", "company_id", "period_end", total_by_pattern(F.col("content").cast("string")).alias("total_shares"), "error")
    return whole.unionByName(found, allowMissingColumns=True)


def best_filings(filings: DataFrame, latest_only: bool = False) -> DataFrame:
    """Per company (and effective date, unless latest_only) the filing with the latest dates: effective, submission, revision."""
    order = [F.col(c).desc_nulls_last() for c in ("effective_date", "submission_date", "revision_date")]
    return latest(filings, ["company_id"] if latest_only else ["company_id", "effective_date"], [*order, F.col("filing_id").desc()])


def sample_documents(holdings: DataFrame) -> DataFrame:
    """XBRL documents that state snapshots of the test tables."""
    by_column = {v: k for k, v in MEMBERS.items()}
    columns = [c for c in holdings.columns if c in by_column]
    ctx = "".join(f'<context id="{c}"><scenario><explicitMember dimension="s:{AXIS}">s:{by_column[c]}</explicitMember></scenario></context>' for c in columns)
    fact = lambda c, ref: F.coalesce(F.concat(F.lit(f'<NumberOfShares contextRef="{ref}">'), F.col(c).cast("string"), F.lit("</NumberOfShares>")), F.lit(""))
    body = F.concat(F.lit(f'<xbrl>{ctx}<context id="{WHOLE_CONTEXT}"/>'), *[fact(c, c) for c in columns], fact("total_shares", WHOLE_CONTEXT), F.lit("</xbrl>"))
    return holdings.select((F.col("company_id") * 100000 + F.datediff("effective_date", F.lit("1990-01-01").cast("date"))).cast("long").alias("filing_id"), "company_id", F.col("effective_date").alias("period_end"), body.alias("content"))
